"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skygrain.llm import (
    chat, exact, langid, lexical, lm, merkle, minhash, mixing, packing, pages, secrets, toxicity, vectors,
)
from skygrain.llm.texts import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Twin of the scan in SQL: the gaps between matches and the matches, their lengths added up.
def _span_sql(kind: str, rank: int, pattern: str, least: int, group: int, options: str) -> str:
    p = pattern.replace("'", "''").replace("}+", "}")
    flags = f", '{options}'" if options else ""
    hits = f"regexp_extract_all(t, '{p}', 0{flags})"
    values = f"regexp_extract_all(t, '{p}', {group}{flags})"
    gaps = f"string_split_regex(t, '{p}'{flags})"
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s AS start, s + length(hit) AS stop, value FROM (
  SELECT doc_id, hits[i] AS hit, vals[i] AS value,
    list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(h) FOR h IN hits[1:i - 1]]), 0) AS s
  FROM (SELECT doc_id, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
    SELECT doc_id, {hits} AS hits, {values} AS vals, {gaps} AS gaps FROM texts)))
WHERE length(value) >= {least}"""


def _secret_sql() -> str:
    parts = [
        _span_sql(k, i, p.removeprefix("(?i)"), n, g, "i" if p.startswith("(?i)") else "")
        for i, (k, p, g, n) in enumerate((*secrets.BASE_KINDS, *secrets.ADDED_KINDS))
    ]
    joined = lambda which: (
        f"coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' "
        f"ORDER BY start, rank){which}, '')"
    )
    return f"""WITH texts AS (SELECT doc_id, source, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT f.*, coalesce(d.source, '') AS source, d.repo FROM found f JOIN texts d USING (doc_id)),
spread AS (SELECT value, count(DISTINCT source) AS n_owners, count(DISTINCT (repo, source)) AS n_repos FROM placed GROUP BY value),
judged AS (SELECT p.*, n_owners, n_repos, CASE WHEN n_owners >= 3 OR n_repos >= 4 THEN 'copied'
    WHEN n_owners = 1 AND regexp_matches(p.value, '[0-9]') AND regexp_matches(p.value, '[A-Za-z]')
      AND NOT regexp_matches(p.value, 'example|changeme|placeholder|your[_-]|dummy|xxxx|\\*\\*\\*\\*', 'i')
      AND length(replace(p.value, p.value[1], '')) > 0 THEN 'live' ELSE 'unclear' END AS verdict
  FROM placed p JOIN spread USING (value))
SELECT t.doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in secrets.BASE_KINDS)},
  sha256({joined(' FILTER (rank < 3)')}) AS base_sha256, {joined(' FILTER (kind IS NOT NULL)')} AS spans,
  {', '.join(f"count(*) FILTER (verdict = '{v}') AS n_{v}" for v in ('live', 'copied', 'unclear'))},
  max(n_owners) AS max_owners, max(n_repos) AS max_repos
FROM texts t LEFT JOIN judged j ON t.doc_id = j.doc_id GROUP BY t.doc_id"""


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), remainder("doc_id", 3) == 1)


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, remainder("doc_id", 5) == 0)


@query("op3_lm_scoring")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


@query("op4_secrets", _secret_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_digest(secrets.find_secrets(docs, repo=F.concat_ws("/", "source", "lang")))


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query("op6_mixing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draws(table(spark, sf_dir, "documents"), mixing.Mixture(
        weights={("domain0",): 2.0, ("domain1", "en"): 3.0}, share=0.8, max_epochs=2))


@query("op7_chat_formatting")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query("op8_embedding_near_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query(
    "op10_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return done.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


@query(
    "op12_lexical_search",
    f"""WITH texts AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
sizes AS (SELECT doc_id, CAST(len(terms) AS BIGINT) AS n FROM texts WHERE len(terms) > 0),
whole AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), whole),
wanted AS (SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
scores AS (SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole GROUP BY ALL),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score FROM scores WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _record_sql(n_chars: str) -> str:
    texts = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


# crc32 of the decimal id, bit by bit.
_CRC = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS UBIGINT)),
  lambda c, b: list_reduce([0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda x, k: xor(x >> 1, CAST(3988292384 AS UBIGINT) * (x & 1)), xor(c, b)), CAST(4294967295 AS UBIGINT)),
  CAST(4294967295 AS UBIGINT))"""

# Levels of each group's tree, then of the tree over the groups' roots; a proof is the other node of each run.
_MERKLE_SQL = f"""WITH RECURSIVE
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY g) AS n FROM (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, {_record_sql('n_chars')} AS leaf,
    CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_record_sql('(n_chars + 1)')} END AS altered FROM documents)),
tree AS (SELECT g, 0 AS lvl, pos, leaf AS h, n FROM leaves UNION ALL
  SELECT g, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tree WHERE n > 1
  GROUP BY g, lvl, pos // 2, n),
tops AS (SELECT g, h AS subroot, max(lvl) OVER () AS high FROM tree WHERE n = 1),
crown AS (SELECT 0 AS lvl, g AS pos, subroot AS h, count(*) OVER () AS n FROM tops UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM crown WHERE n > 1
  GROUP BY lvl, pos // 2, n),
steps AS (SELECT l.g, l.pos, t.lvl AS step, s.h, xor(l.pos >> t.lvl, 1) < l.pos >> t.lvl AS first
    FROM leaves l JOIN (SELECT DISTINCT g, lvl FROM tree WHERE n > 1) t ON t.g = l.g
    LEFT JOIN tree s ON s.g = l.g AND s.lvl = t.lvl AND s.pos = xor(l.pos >> t.lvl, 1)
  UNION ALL
  SELECT l.g, l.pos, 100 + t.lvl, s.h, xor(l.g >> t.lvl, 1) < l.g >> t.lvl
    FROM leaves l CROSS JOIN (SELECT DISTINCT lvl FROM crown WHERE n > 1) t
    LEFT JOIN crown s ON s.lvl = t.lvl AND s.pos = xor(l.g >> t.lvl, 1)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY g, pos ORDER BY step) AS k FROM steps),
folded AS (SELECT g, pos, 0 AS k, coalesce(altered, leaf) AS h FROM leaves UNION ALL
  SELECT f.g, f.pos, f.k + 1, sha256(CASE WHEN o.h IS NULL THEN f.h WHEN o.first THEN o.h || f.h ELSE f.h || o.h END)
  FROM folded f JOIN ordered o ON o.g = f.g AND o.pos = f.pos AND o.k = f.k + 1),
proofs AS (SELECT l.g, l.pos, sha256(coalesce(string_agg(o.h, '' ORDER BY o.k), '')) AS proof_sha256
  FROM leaves l LEFT JOIN ordered o ON o.g = l.g AND o.pos = l.pos GROUP BY l.g, l.pos),
ends AS (SELECT g, pos, arg_max(h, k) AS folded_root FROM folded GROUP BY g, pos),
top AS (SELECT h AS root FROM crown WHERE n = 1)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN tops USING (g) JOIN proofs USING (g, pos) JOIN ends USING (g, pos), top"""


@query("op13_merkle_manifest", _MERKLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


@query("op11_html_extraction")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))
