"""Secret scans with corpus-wide ownership counts, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygrain.plans.durable import materialize

# Kinds in their listing order: (name, pattern, group of the value, least length of the value).
BASE_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}+", 0, 20),
    ("hex", r"[0-9a-f]{24,}+", 0, 24),
)
# Shapes that name their issuer: signed web tokens, hosted-repository and chat tokens, private key headers.
ADDED_KINDS = (
    (
        "issued",
        r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+|gh[pousr]_[A-Za-z0-9]{30,}"
        r"|xox[abprs]-[A-Za-z0-9-]{10,}|-----BEGIN [A-Z ]*PRIVATE KEY-----",
        0, 10,
    ),
)
CHUNK = 256  # matches of a text that are placed one after another; chunks are placed apart
# Words that mark a value as a placeholder.
PLACEHOLDER = r"(?i)example|changeme|placeholder|your[_-]|dummy|xxxx|\*\*\*\*|^(.)\1+$"


def spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """Array of ``start, rank, kind, end, hash, odd`` (code points, end exclusive) of one kind's matches in a text.

    The text between the matches and the matches themselves come from the same pattern, so their lengths add up to
    the positions. The value is kept as a hash only; ``odd`` says that it looks like a real credential.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        found = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], found).alias("out"))

    def bases(chunks: Column) -> Column:
        """Where each chunk starts: the lengths of all chunks before it."""
        size = lambda chunk: F.aggregate(chunk, F.lit(0), lambda n, x: n + x["gap"] + F.length(x["hit"]))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(F.transform(chunks, size), first, lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def placed_in(chunks: Column) -> Column:
        return F.flatten(F.zip_with(chunks, bases(chunks), lambda chunk, at: F.aggregate(
            chunk, F.struct(at.alias("at"), empty.alias("out")), place, lambda acc: acc["out"])))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    rows = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        F.arrays_zip(hits.alias("hit"), values.alias("value")),
        lambda g, h: F.struct(g.alias("gap"), h["hit"].alias("hit"), h["value"].alias("value")),
    )
    cut = lambda found: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda c: F.slice(found, c * CHUNK + 1, CHUNK))
    # Appending copies a list, so lists stay short; a list of one keeps what is in it from being worked out twice.
    chunked = F.flatten(F.transform(F.array(rows), cut))
    placed = F.flatten(F.transform(F.array(chunked), placed_in))
    kept = F.filter(placed, lambda x: F.length(x["value"]) >= least)
    shaped = F.transform(
        kept,
        lambda x: F.struct(
            x["start"].alias("start"),
            F.lit(order).alias("rank"),
            F.lit(kind).alias("kind"),
            x["end"].alias("end"),
            F.sha2(x["value"], 256).alias("hash"),
            (x["value"].rlike("[0-9]") & x["value"].rlike("[A-Za-z]") & ~x["value"].rlike(PLACEHOLDER)).alias("odd"),
        ),
    )
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,hash:string,odd:boolean>>")
    return F.when(text.rlike(pattern), shaped).otherwise(none)


def _joined(found: Column) -> Column:
    piece = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.concat_ws(",", F.transform(found, piece))


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo: Column | None = None,
    owner: Column | None = None,
    copied_owners: int = 3,
    copied_repos: int = 4,
) -> DataFrame:
    """Secret candidates of every row and how widely each value is spread over the corpus.

    Returns one row per input row: ``doc_id, found`` (array of ``start, rank, kind, end, hash, odd, n_repos,
    n_owners, verdict``, by start, then kind). ``verdict`` is ``copied`` where at least ``copied_owners`` owners or
    ``copied_repos`` repositories hold the value, ``live`` where one owner holds it, in fewer repositories, and it looks
    like a real credential, and ``unclear`` otherwise.

    Values are counted by hash over distinct (value, repository, owner), combined within tasks first; null
    repositories or owners count as one unnamed one. A null text counts as empty and has no candidates; an empty
    table gives an empty result. Repeated rows and null ids are reported row by row; other columns are ignored.
    """
    repo = F.col("source") if repo is None else repo
    owner = F.col("source") if owner is None else owner
    text = F.col("_text")
    kinds = (*BASE_KINDS, *ADDED_KINDS)
    scanned = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(repo.cast("string"), F.lit("")).alias("repo"),
            F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
            F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        )
        .select(
            "doc_id", "repo", "owner",
            F.array_sort(F.concat(*[spans(text, k, i, p, g, n) for i, (k, p, g, n) in enumerate(kinds)])).alias("found"),
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "secret-spans",
    )
    each = scanned.select("row", "repo", "owner", F.explode("found").alias("x"))
    owners = each.select(F.col("x.hash").alias("hash"), "repo", "owner").distinct()
    spread = (
        owners.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n_repos"))
        .groupBy("hash").agg(F.sum("n_repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    )
    verdict = (
        F.when((F.col("n_owners") >= copied_owners) | (F.col("n_repos") >= copied_repos), "copied")
        .when((F.col("n_owners") == 1) & F.col("x.odd"), "live")
        .otherwise("unclear")
    )
    judged = (
        each.select("row", "x", F.col("x.hash").alias("hash"))
        .join(spread, "hash")
        .withColumn("verdict", verdict)
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("x.*", "n_repos", "n_owners", "verdict"))).alias("found"))
    )
    return scanned.select("row", "doc_id").join(judged, "row", "left").select("doc_id", "found")


def secret_digest(found: DataFrame) -> DataFrame:
    """The report of the scan: counts per base kind, digest of the base spans, all spans, counts per verdict, and the
    largest numbers of owners and repositories that a value of the row is found in (null without values).
    """
    none = F.array().cast(found.schema["found"].dataType)
    rows = found.select("doc_id", F.coalesce("found", none).alias("found"))
    count = lambda field, value: F.size(F.filter("found", lambda x: x[field] == value)).cast("long")
    base = F.filter("found", lambda x: x["rank"] < len(BASE_KINDS))
    return rows.select(
        "doc_id",
        *[count("kind", k).alias(f"n_{k}") for k, *_ in BASE_KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        *[count("verdict", v).alias(f"n_{v}") for v in ("live", "copied", "unclear")],
        *[F.array_max(F.transform("found", lambda x: x[f"n_{n}"])).alias(f"max_{n}") for n in ("owners", "repos")],
    )
