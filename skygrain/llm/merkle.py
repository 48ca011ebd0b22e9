"""A Merkle manifest of a table: blocks of hash tree in van Emde Boas layout, their roots hashed again in blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from skygrain.llm.texts import by_key
from skygrain.plans.durable import materialize
from skygrain.plans.skew import GROUP_ROWS, ROW_NO, cut_ranges, number_rows, range_offsets

BLOCK_HEIGHT = 10  # a block has 2 ** 10 leaves and 64 KiB of digests
SIZE = 32
LEFT, RIGHT, NONE = 0, 1, 2  # where a sibling stands; NONE: a lone node of its run
STEP = SIZE + 1


@lru_cache(maxsize=32)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """Slots of the nodes of each depth (0: the root) of a full tree in van Emde Boas order.

    The upper half of the levels is stored first, then the subtrees below it one after another, each by the same rule.
    """
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top = levels // 2
    upper, lower = addresses(top), addresses(levels - top)
    start = (1 << top) - 1 + np.arange(1 << top) * ((1 << (levels - top)) - 1)
    return upper + tuple((start[:, None] + inner).ravel() for inner in lower)


def node_hash(parts: Iterable[bytes]) -> bytes:
    """Hash of digests, joined as hex text."""
    return sha256("".join(p.hex() for p in parts).encode()).digest()


class Block:
    """A subtree of ``count`` leaves and ``height`` levels above them; the digests lie in one buffer."""

    def __init__(self, height: int, count: int, nodes: bytes | bytearray):
        self.height, self.count, self.nodes = height, count, nodes
        self.slots = addresses(height + 1)

    @classmethod
    def build(cls, height: int, leaves: Sequence[bytes]) -> Block:
        block = cls(height, len(leaves), bytearray(SIZE * ((2 << height) - 1)))
        for i, leaf in enumerate(leaves):
            block.put(0, i, leaf)
        for level in range(1, height + 1):
            below = block.width(level - 1)
            for i in range(block.width(level)):
                block.put(level, i, node_hash(block.get(level - 1, j) for j in range(2 * i, min(2 * i + 2, below))))
        return block

    def width(self, level: int) -> int:
        return -(-self.count // (1 << level))

    def _at(self, level: int, i: int) -> int:
        return SIZE * int(self.slots[self.height - level][i])

    def get(self, level: int, i: int) -> bytes:
        at = self._at(level, i)
        return bytes(self.nodes[at : at + SIZE])

    def put(self, level: int, i: int, digest: bytes) -> None:
        at = self._at(level, i)
        self.nodes[at : at + SIZE] = digest

    def path(self, i: int) -> bytes:
        """The siblings from leaf ``i`` to below the block's root: a side byte and a digest for each level."""
        steps = []
        for level in range(self.height):
            j = (i >> level) ^ 1
            if j >= self.width(level):
                steps.append(bytes([NONE]) + bytes(SIZE))
            else:
                steps.append(bytes([LEFT if j < i >> level else RIGHT]) + self.get(level, j))
        return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    return [path[at + 1 : at + STEP] for at in range(0, len(path), STEP) if path[at] != NONE]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for at in range(0, len(path), STEP):
        other = path[at + 1 : at + STEP]
        leaf = node_hash([[other, leaf], [leaf, other], [leaf]][path[at]])
    return leaf


def record(fields: Iterable[Column]) -> Column:
    """Digest of a row: each field as ``-`` when null, else its byte count, a colon and its value."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _blocks(schema: pa.Schema, height: int):
    """Rows sorted by (grp, block, pos) to one row per block."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_key(batches, ["grp", "block"]):
            total = rows.column("total")[0].as_py()
            h = height if total > 1 << height else (total - 1).bit_length()
            made = Block.build(h, rows.column("leaf").to_pylist())
            listed = {n: pa.array([rows.column(n).to_pylist()], schema.field(f"{n}s").type) for n in ("id", "altered")}
            yield pa.RecordBatch.from_arrays([
                rows.column("grp").slice(0, 1).combine_chunks(), rows.column("block").slice(0, 1).combine_chunks(),
                pa.array([h], pa.int32()), pa.array([bytes(made.nodes)]), pa.array([made.get(h, 0)]),
                listed["id"], listed["altered"], pa.array([total], pa.int64()),
            ], schema=schema)

    return run


def _tier(leaves: DataFrame, height: int, label: str) -> DataFrame:
    """Blocks ``grp, block, height, nodes, root, ids, altereds, total`` over ``grp, pos, total, id, leaf, altered``."""
    grp, ident = leaves.schema["grp"].dataType, leaves.schema["id"].dataType
    schema = pa.schema([
        ("grp", to_arrow_type(grp)), ("block", pa.int64()), ("height", pa.int32()), ("nodes", pa.binary()), ("root", pa.binary()),
        ("ids", pa.list_(to_arrow_type(ident))), ("altereds", pa.list_(pa.binary())), ("total", pa.int64()),
    ])
    ddl = (f"grp {grp.simpleString()}, block long, height int, nodes binary, root binary, "
           f"ids array<{ident.simpleString()}>, altereds array<binary>, total long")
    dealt = leaves.withColumn("block", F.shiftright("pos", height)).repartition("grp", "block")
    rows = dealt.sortWithinPartitions("grp", "block", "pos").select("grp", "block", "pos", "total", "id", "leaf", "altered")
    return materialize(rows.mapInArrow(_blocks(schema, height), ddl), label)


def _tiers(leaves: DataFrame, height: int, label: str) -> list[DataFrame]:
    """Block tables from the leaves up, until every group is one block."""
    most = leaves.agg(F.max("total")).first()[0] or 0
    tiers = [_tier(leaves, height, f"{label}-0")]
    while most > 1 << height:
        most = -(-most >> height)
        above = tiers[-1].filter(F.col("total") > 1 << height).select(
            "grp", F.col("block").alias("pos"), F.shiftright(F.col("total") + ((1 << height) - 1), height).alias("total"),
            F.col("block").alias("id"), F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("altered"),
        )
        tiers.append(_tier(above, height, f"{label}-{len(tiers)}"))
    return tiers


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``pos`` within ``grp`` and its ``total``, from sorted ranges; a large group spans many of them."""
    ranges = cut_ranges(rows, ["grp"], order, shuffled=True)
    placed = number_rows(ranges, range_offsets(ranges, ["grp"]), ["grp"], order)
    return placed.withColumn("pos", F.col(ROW_NO) - 1).withColumn("total", F.col(GROUP_ROWS))


def _paths(ident: pa.DataType, final: bool):
    """Blocks with the path above them to one row per leaf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                block = {n: row.column(n)[0].as_py() for n in ("height", "nodes", "above", "root", "subroot")}
                ids = row.column("ids").flatten()
                n = len(ids)
                tree = Block(block["height"], n, block["nodes"])
                leaves = [tree.get(0, j) for j in range(n)]
                columns = {
                    "grp": pa.array([row.column("grp")[0].as_py()] * n, row.column("grp").type), "id": ids.cast(ident),
                    "leaf": pa.array(leaves, pa.binary()),
                    "path": pa.array([tree.path(j) + block["above"] for j in range(n)], pa.binary()),
                    "subroot": pa.array([block["subroot"]] * n, pa.binary()), "root": pa.array([block["root"]] * n, pa.binary()),
                }
                if final:
                    columns["altered"] = row.column("altereds").flatten().cast(pa.binary())
                yield pa.record_batch(columns)

    return run


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Paths from the leaves of the lowest tier up to the root, given the path above each group's top block.

    Each tier's blocks are joined with one path per block, not per leaf; the leaves' own paths are made at the end.
    """
    for level in range(len(tiers) - 1, -1, -1):
        blocks = tiers[level]
        ident = blocks.schema["ids"].dataType.elementType
        same = F.col("b.grp").eqNullSafe(F.col("a.grp")) & F.col("b.block").eqNullSafe(F.col("a.block"))
        opened = blocks.alias("b").join(above.alias("a"), same).select(
            "b.grp", "b.height", "b.nodes", "b.ids", "b.altereds", F.col("a.path").alias("above"), "a.subroot", "a.root")
        ddl = f"grp {blocks.schema['grp'].dataType.simpleString()}, id {ident.simpleString()}, leaf binary, path binary, " \
              "subroot binary, root binary" + (", altered binary" if not level else "")
        rows = opened.mapInArrow(_paths(to_arrow_type(ident), not level), ddl)
        if not level:
            return rows
        below = rows.select("grp", F.col("id").alias("block"), "path", "subroot", "root")
        lower = above.alias("a").join(blocks.alias("b"), same, "left_anti")  # groups whose top block is further down
        above = below.unionByName(lower.select(*below.columns))
    raise AssertionError("no tier")


@dataclass
class Manifest:
    """Block tables of each group's tree (``groups``) and of the tree over the groups' roots (``forest``), leaves first."""

    groups: list[DataFrame]
    forest: list[DataFrame]

    def proofs(self) -> DataFrame:
        """``grp, id, leaf, path, subroot, root, altered`` for every leaf; ``path`` holds the siblings up to the root."""
        tops = self.forest[-1].select("grp", "block", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"), "root")
        over = _down(self.forest, tops)
        lang = over.select(F.col("id").alias("grp"), F.lit(0).cast("long").alias("block"), "path",
                           F.col("leaf").alias("subroot"), "root")
        return _down(self.groups, lang)


def build(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    id_col: str = "doc_id",
    altered: Column | None = None,
    height: int = BLOCK_HEIGHT,
) -> Manifest:
    """Hash trees over the rows of ``docs``: one for each value of ``group``, and one over their roots.

    A leaf is the digest of the named fields. In a group leaves ascend by id (null first, equal ids by digest); two
    consecutive nodes become one, a last odd node is hashed alone. Groups ascend bytewise, null first, so a null group
    is a group of its own. Empty and null fields have different digests. Repeated rows are leaves of their own. An
    empty table has no trees and no proofs. Other columns are ignored, whatever their names.

    ``altered`` is a second digest per row that proofs carry along, for checks of changed rows.

    Rows are numbered by sorted ranges, so a group of any size is spread over the cluster. Blocks of 2 ** ``height``
    leaves are built in tasks and written; their roots are the leaves of the next tier, until one block is left.
    """
    own = record(F.col(f) for f in fields)
    leaves = materialize(docs.select(
        F.col(group).alias("grp"), F.col(id_col).alias("id"), own.alias("leaf"),
        (F.lit(None).cast("binary") if altered is None else altered).alias("altered"),
    ), "leaves")
    groups = _tiers(_numbered(leaves, ["id", "leaf"]), height, "tree")
    roots = groups[0].filter(F.col("total") <= 1 << height)
    for t in groups[1:]:
        roots = roots.select("grp", "root").unionByName(t.filter(F.col("total") <= 1 << height).select("grp", "root"))
    tops = roots.select(F.lit(0).alias("grp"), F.col("grp").alias("id"), F.col("root").alias("leaf"),
                        F.lit(None).cast("binary").alias("altered"))
    return Manifest(groups, _tiers(_numbered(tops, ["id"]), height, "forest"))


def _verdicts(ident: pa.DataType):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")}
            for leaf, path, subroot, root, other in zip(*(
                    b.column(n).to_pylist() for n in ("leaf", "path", "subroot", "root", "altered"))):
                led = fold(leaf if other is None else other, path)
                for n, v in zip(out, (leaf.hex(), subroot.hex(), root.hex(), node_hash(siblings(path)).hex(), led.hex(), led == root)):
                    out[n].append(v)
            yield pa.record_batch({"id": b.column("id").cast(ident)} | {
                n: pa.array(v, pa.bool_() if n == "verified" else pa.string()) for n, v in out.items()})

    return run


def verify(proofs: DataFrame) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified``: each row's (altered) leaf folded along its path."""
    ident = proofs.schema["id"].dataType
    ddl = (f"id {ident.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean")
    return proofs.select("id", "leaf", "path", "subroot", "root", "altered").mapInArrow(_verdicts(to_arrow_type(ident)), ddl)


def tampered(docs: DataFrame, one_in: int = 7) -> DataFrame:
    """Verdict on every row when one is added to ``n_chars`` of the rows whose id's crc32 ``one_in`` divides.

    Null ``n_chars`` stay null; a null id is never altered.
    """
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(one_in)) == 0
    changed = record([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    made = build(docs, altered=F.when(hit & F.col("n_chars").isNotNull(), changed))
    return verify(made.proofs()).withColumnRenamed("id", "doc_id")
