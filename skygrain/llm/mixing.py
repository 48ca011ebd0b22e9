"""Mixing sources to target weights: budgets down a domain-language-source tree, seeded epochs per leaf."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrain.plans.durable import materialize

LEVELS = ("domain", "lang", "source")
RADIX = 1024  # buckets per step of the descent to a leaf's cut
MOST_LEAVES = 200_000  # leaves of the mixture; the budgets are worked out on the driver


@dataclass
class Mixture:
    """Target weights. ``weights`` maps a path, as ``("web",)`` or ``("web", "en")``, to its weight among siblings;
    a path that is not named weighs ``default``. ``share`` of all tokens is the budget, unless ``budget`` gives it.
    A leaf's documents may be used up to ``max_epochs`` times, each epoch in an order of its own."""

    weights: dict[tuple[str, ...], float] = field(default_factory=dict)
    default: float = 1.0
    share: float = 0.8
    budget: int | None = None
    max_epochs: int = 2
    seed: int = 17


def default_domain(source: Column) -> Column:
    """The domain of a source where none is given: one of four groups by name."""
    return F.concat(F.lit("domain"), F.pmod(F.crc32(F.coalesce(source.cast("string"), F.lit(""))), F.lit(4)))


def allot(total: float, capacity: dict[tuple[str, ...], float], mixture: Mixture) -> dict[tuple[str, ...], float]:
    """Budget of every leaf path. Each node's budget is split among its children by weight; what a child cannot use
    goes to its siblings by weight, and only what all of them cannot use is left to the ancestors' other children."""
    under: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
    room: dict[tuple[str, ...], float] = {}
    for leaf, tokens in capacity.items():
        for depth in range(len(leaf) + 1):
            node = leaf[:depth]
            room[node] = room.get(node, 0.0) + tokens
            if depth:
                under.setdefault(leaf[: depth - 1], set()).add(node)
    out: dict[tuple[str, ...], float] = {}

    def give(node: tuple[str, ...], budget: float) -> None:
        children = sorted(under.get(node, ()))
        if not children:
            out[node] = budget
            return
        got = dict.fromkeys(children, 0.0)
        open_ = [c for c in children if room[c] > 0]
        left = min(budget, room[node])
        while open_ and left > 1e-9:
            weight = {c: mixture.weights.get(c, mixture.default) for c in open_}
            whole = sum(weight.values())
            if whole <= 0:
                break
            full = [c for c in open_ if got[c] + left * weight[c] / whole >= room[c]]
            if not full:
                for c in open_:
                    got[c] += left * weight[c] / whole
                break
            for c in full:
                left -= room[c] - got[c]
                got[c] = room[c]
            open_ = [c for c in open_ if c not in full]
        for c in children:
            give(c, got[c])

    give((), min(total, room.get((), 0.0)))
    return out


def _digit(level: int) -> Column:
    """The level-th digit of the 60-bit order key."""
    return F.shiftright("key", 10 * (5 - level)).bitwiseAND(F.lit(RADIX - 1))


def mix(docs: DataFrame, mixture: Mixture | None = None, domain: Column | None = None) -> DataFrame:
    """The rows drawn for the mixture, with all columns of ``docs`` (a row drawn in k epochs comes k times)."""
    return draws(docs, mixture, domain, keep=docs.columns)


def draws(docs: DataFrame, mixture: Mixture | None = None, domain: Column | None = None,
          keep: list[str] | None = None) -> DataFrame:
    """Which documents are drawn: ``doc_id, domain, lang, source, epoch, n_tokens`` (or the columns in ``keep``).

    A leaf is a (domain, language, source); nulls count as the empty name. Tokens are words between white space; a
    null or empty text has none, costs nothing and comes once, with the first epoch, whatever its leaf's budget. Within an
    epoch a leaf's documents are ordered by a hash of (seed, epoch, id, text); equal rows are drawn together. A leaf
    takes whole epochs while its budget lasts, then the prefix of the next epoch whose tokens stay within the
    budget. An empty table gives an empty result; other columns pass through or are ignored.

    The prefix is found without sorting a leaf: token sums per bucket of the order key are combined before each
    shuffle, the bucket that the budget ends in is cut again, and so on down to single key values. Leaf tables are
    broadcast, as a leaf table above ``MOST_LEAVES`` rows is refused.
    """
    mixture = mixture or Mixture()
    names = docs.columns
    leaf = [F.coalesce(c.cast("string"), F.lit("")) for c in (
        default_domain(F.col("source")) if domain is None else domain, F.col("lang"), F.col("source"))]
    tokens = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
                       *[c.alias(n) for c, n in zip(leaf, LEVELS)], tokens.alias("n_tokens"))
    sums = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    leaves = sums.limit(MOST_LEAVES + 1).collect()
    if len(leaves) > MOST_LEAVES:
        raise ValueError(f"the mixture has more than {MOST_LEAVES} leaves; group its sources into domains")
    have = {tuple(r[n] for n in LEVELS): r.tokens for r in leaves}
    total = mixture.budget if mixture.budget is not None else mixture.share * sum(have.values())
    budgets = allot(total, {k: v * mixture.max_epochs for k, v in have.items()}, mixture)
    # Per leaf: whole epochs, and the tokens that its last epoch may take.
    state = []
    for k, tokens_n in have.items():
        whole = min(mixture.max_epochs, int(budgets[k] // tokens_n)) if tokens_n else 1
        state.append((*k, whole, int(budgets[k] - whole * tokens_n) if tokens_n else 0))
    spark = docs.sparkSession
    plan = spark.createDataFrame(state, "domain string, lang string, source string, whole int, room long")
    text_hash = F.coalesce(F.col("doc.text"), F.lit(""))
    seeded = F.xxhash64(F.lit(mixture.seed), F.col("whole"), F.col("doc.doc_id"), text_hash)
    keyed = rows.join(F.broadcast(plan), list(LEVELS)).withColumn("key", F.shiftrightunsigned(seeded, 4))
    light = materialize(
        keyed.filter((F.col("whole") < mixture.max_epochs) & (F.col("n_tokens") > 0)).select(*LEVELS, "key", "n_tokens"),
        "mixture-keys")
    cut = {tuple(s[:3]): [0, s[4]] for s in state}
    for level in range(6):
        # ``cut``: every key below it is taken; the bucket that starts there is being cut.
        step = 1 << (10 * (5 - level))
        now = F.broadcast(spark.createDataFrame(
            [(*k, c, left >= 0) for k, (c, left) in cut.items()],
            "domain string, lang string, source string, cut long, open boolean"))
        inside = light.join(now, list(LEVELS)).filter(
            (F.col("open") & (F.col("key") >= F.col("cut")) & (F.col("key") - F.col("cut") < RADIX * step)))
        found = inside.groupBy(*LEVELS, _digit(level).alias("digit")).agg(
            F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n"))
        up_to = F.sum("tokens").over(Window.partitionBy(*LEVELS).orderBy("digit"))
        room = F.broadcast(spark.createDataFrame(
            [(*k, r) for k, (_, r) in cut.items()], "domain string, lang string, source string, left long"))
        beyond = F.when(F.col("up_to") > F.col("left"), F.col("digit"))
        fits = found.withColumn("up_to", up_to).join(room, list(LEVELS)).groupBy(*LEVELS).agg(
            F.min(beyond).alias("over"),
            F.min_by("n", beyond).alias("n"),
            F.max(F.when(F.col("up_to") <= F.col("left"), F.col("up_to"))).alias("used"),
        )
        rows_of = fits.collect()
        missing = set(cut) - {tuple(r[n] for n in LEVELS) for r in rows_of}
        for k in missing:
            cut[k][1] = -1
        for r in rows_of:
            k = tuple(r[n] for n in LEVELS)
            cut[k][0] += step * (r.over if r.over is not None else RADIX)
            cut[k][1] -= r.used or 0
            if r.over is None or r.n == 1:
                cut[k][1] = -1  # the whole bucket fits, or a single row does not: nothing is left to cut
        if all(left < 0 for _, left in cut.values()):
            break
    ends = F.broadcast(spark.createDataFrame(
        [(*k, c) for k, (c, _) in cut.items()], "domain string, lang string, source string, cut long"))
    short = ((F.col("whole") < mixture.max_epochs) & (F.col("key") < F.col("cut"))).cast("int")
    drawn = keyed.join(ends, list(LEVELS)).withColumn(
        "times", F.when(F.col("n_tokens") == 0, 1).otherwise(F.col("whole") + short))
    each = drawn.filter("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    if keep is not None:
        return each.select(*[F.col(f"doc.`{c}`").alias(c) for c in keep])
    return each.select(F.col("doc.doc_id").alias("doc_id"), *LEVELS, "epoch", "n_tokens")
