"""Mixing sources to target weights by Poisson replication (operator 6).

A source whose share is to become w of N rows in all is repeated at the mean
rate w * N / n.  Each document draws its own number of copies from the Poisson
law of that mean, by inverting the law at a uniform number hashed from seed
and id; it is exploded by that number, and the copies are dealt to partitions
and sorted by a hash of seed, id and copy, which is a global shuffle in one
exchange.  Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimcheck.llm._util import prepare

BROADCAST_SOURCES = 100_000  # a table of at most so many sources is broadcast
STEP = 32.0  # means above this are drawn as sums of parts of at most this mean


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the md5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def inverse_poisson(mean: Column, u: Column) -> Column:
    """Smallest k whose Poisson probability of at most k reaches u; for means up to STEP."""
    start = F.struct(F.lit(0).cast("long").alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("c"))

    def step(s, i):
        p = s["p"] * mean / i
        return F.when(s["c"] >= u, s).otherwise(F.struct(i.cast("long").alias("k"), p.alias("p"), (s["c"] + p).alias("c")))

    most = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda s: s["k"])


def copies(mean: Column, seed: str, key: Column) -> Column:
    """Poisson count of any mean: a sum of independent draws of equal parts of it."""
    parts = F.greatest(F.lit(1), F.ceil(mean / STEP)).cast("int")
    draw = lambda i: inverse_poisson(mean / parts, uniform(F.lit(seed), key, i.cast("string")))
    total = F.aggregate(F.sequence(F.lit(1), parts), F.lit(0).cast("long"), lambda a, i: a + draw(i))
    return F.when(mean > 0, total).otherwise(F.lit(0).cast("long"))


def rates(docs: DataFrame, source_col: str, weights: dict[str | None, float] | None, alpha: float, rows: int | None) -> DataFrame:
    """(source, rate): mean copies of a document of each source, null being a source too."""
    n = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(alpha))
    else:
        w = F.lit(0.0)
        for name, value in weights.items():
            w = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(w)
    n = n.withColumn("w", w)
    all_w = n.agg(F.sum("w")).scalar()
    want = F.lit(rows) if rows is not None else n.agg(F.sum("n")).scalar()
    share = F.when(all_w > 0, F.col("w") / all_w).otherwise(F.lit(0.0))
    return n.select("source", (share * want / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: dict[str | None, float] | None = None,
    alpha: float = 0.5,
    rows: int | None = None,
    seed: str = "mix-1",
    copy_col: str = "copy",
) -> DataFrame:
    """All columns of ``docs`` plus the copy's number from 0, shuffled globally.

    ``weights``: target share of each source (any scale; a source not named
    gets 0); without it a source weighs its row count to the power ``alpha``.
    ``rows``: the expected size of the mix, by default that of ``docs``.

    Defined cases: a null source is a source of its own; a null id hashes as
    "null"; rows with one id draw the same number; weights that are all 0 give
    an empty mix; a column named ``copy_col`` is replaced; an empty table gives
    an empty mix.  A hot source costs no more than its rows: counts combine
    before their shuffle, and the table of rates is broadcast only if small.
    """
    prepare(docs.sparkSession)
    table = rates(docs, source_col, weights, alpha, rows)
    table = table.select(F.coalesce("source", F.lit("")).alias("__s"), F.col("source").isNull().alias("__null"), F.col("rate").alias("__rate"))
    if table.count() <= BROADCAST_SOURCES:
        table = F.broadcast(table)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    src = F.col(f"`{source_col}`").cast("string")
    names = [c for c in docs.columns if c != copy_col]
    joined = docs.withColumns({"__src": F.coalesce(src, F.lit("")), "__isnull": src.isNull()})
    joined = joined.join(table, (F.col("__src") == F.col("__s")) & (F.col("__isnull") == F.col("__null")))
    # -1, 0 as bounds of an empty sequence would count down: rows without a copy go first
    counted = joined.withColumn("__copies", copies(F.col("__rate"), seed, key)).where("__copies > 0")
    exploded = counted.select(*[F.col(f"`{c}`") for c in names], F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)).alias(copy_col))
    place = F.xxhash64(F.lit(seed), key, F.col(f"`{copy_col}`"))
    return exploded.withColumn("__place", place).repartition("__place").sortWithinPartitions("__place").drop("__place")


def oracle_sql(alpha: float = 0.5, seed: str = "mix-1", table: str = "documents", columns: str = "d.doc_id, d.text, d.lang, d.source, d.n_chars") -> str:
    """The same mix in DuckDB SQL, for means up to STEP; the Poisson law is summed anew there."""
    return f"""
WITH n AS (SELECT source, count(*) AS n FROM {table} GROUP BY source),
w AS (SELECT source, n, pow(CAST(n AS DOUBLE), {alpha}) AS w FROM n),
r AS (SELECT source, w / (SELECT sum(w) FROM w) * (SELECT sum(n) FROM n) / n AS mean FROM w),
law AS (
  SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
  FROM r, range(0, 200) AS t(k)
),
u AS (
  SELECT {columns}, (CAST(('0x' || substr(md5('{seed}|' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || '|1'), 1, 13)) AS BIGINT) + 0.5)
    / 4503599627370496.0 AS u
  FROM {table} d
),
c AS (
  SELECT u.*, (SELECT min(k) FROM law WHERE law.source IS NOT DISTINCT FROM u.source AND law.below >= u.u) AS copies FROM u
)
SELECT c.* EXCLUDE (u, copies), CAST(t.k AS BIGINT) AS copy
FROM c, range(0, 200) AS t(k) WHERE t.k < c.copies
"""
