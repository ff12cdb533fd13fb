"""Line dedup by distinct-site spread: boilerplate that many sites carry is cut out of the texts.

Every line (trimmed of spaces, not blank) is hashed. One HyperLogLog sketch of sites a line hash is built by
aggregation: partial sketches merge, so a line that stands in a third of all documents costs one small sketch a
task. Lines whose estimate is clearly over the threshold are boilerplate, clearly under it not; those within
``BAND`` of it get an exact distinct count of their sites. Boilerplate lines are then cut wherever they stand.

A document that is boilerplate and nothing else is a copy that many sites carry: it stays whole, for near-duplicate
removal to decide on. Every other document loses its boilerplate lines, however little is left.

Defined cases: null texts have no lines and stay null; blank lines are kept and never count; a null site is no site;
repeated lines of a document are all cut; copies, repeated rows, and equal or null ids are told apart by id and text;
empty tables give empty results; the lines of a very long text are shuffled as hashes, its flags are as many as its distinct
boilerplate lines; a column that has the name of ``out`` stays, the new one takes the next free name (``free_name``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import free_name, quoted, text_of

MIN_SITES = 10
LG_K = 12            # 4096 registers: a relative standard error of 1.6 %
BAND = 0.1           # six standard errors


def split_lines(text: str) -> Column:
    return F.split(text_of(text), "\n")


def _hash(line: Column) -> Column:
    return F.when(F.trim(line) != "", F.xxhash64(F.trim(line)))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(h, site) rows -> the line hashes ``h`` that at least ``min_sites`` distinct sites carry."""
    spread = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
    spread = materialize(spread.where(F.col("sites") >= min_sites - max(1.0, BAND * min_sites)))
    sure = F.col("sites") > min_sites + max(1.0, BAND * min_sites)
    near = spread.where(~sure).select("h")
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exact = (lines.select("h", "site").join(near, "h", "left_semi").repartition(n, "h", "site").distinct()
             .groupBy("h").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites))
    return materialize(spread.where(sure).select("h").union(exact.select("h")))


def with_kept_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source", out: str = "lines",
                    min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` plus a struct: n_lines (not blank), n_removed, kept (the text that is left; null stays null)."""
    key = F.xxhash64(F.col(quoted(id_col)), F.col(quoted(text)))
    lines = materialize(
        docs.select(key.alias("key"), F.when(F.col(quoted(site)).isNotNull(), F.xxhash64(F.col(quoted(site)))).alias("site"),
                    F.explode(split_lines(text)).alias("line"))
        .select("key", "site", _hash(F.col("line")).alias("h")).where(F.col("h").isNotNull()))
    bad = boilerplate(lines.select("h", "site"), min_sites)
    k, flags = free_name(docs, "line_key"), free_name(docs, "line_flags")
    found = lines.join(bad, "h", "left_semi").groupBy("key").agg(F.collect_set("h").alias(flags)).withColumnRenamed("key", k)
    got = docs.withColumn(k, key).join(found, k, "left")
    none = F.array().cast("array<bigint>")
    flag = F.coalesce(F.col(flags), none)
    is_bad = lambda line: F.coalesce(F.array_contains(flag, _hash(line)), F.lit(False))
    every = split_lines(text)
    chars = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), lambda s, x: s + F.length(F.trim(x)))
    cut = F.filter(every, is_bad)
    act = F.col(flags).isNotNull() & (chars(cut) < chars(every))
    kept = F.when(act, F.array_join(F.filter(every, lambda x: ~is_bad(x)), "\n")).otherwise(F.col(quoted(text)))
    counted = F.size(F.filter(every, lambda x: F.trim(x) != "")).cast("bigint")
    return got.withColumn(free_name(docs, out), F.struct(counted.alias("n_lines"), F.when(act, F.size(cut)).otherwise(0).cast("bigint").alias("n_removed"),
                                        kept.alias("kept"))).drop(k, flags)


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source",
                       n_chars: str | None = "n_chars", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` in the same columns, boilerplate lines cut from every document that holds anything else; ``n_chars`` is
    counted anew where lines were cut."""
    name = free_name(docs, "lines")
    got = with_kept_lines(docs, id_col, text, site, name, min_sites)
    new = {text: F.col(name)["kept"]}
    if n_chars and n_chars in docs.columns:
        new[n_chars] = F.when(F.col(name)["n_removed"] > 0, F.length(F.col(name)["kept"]).cast(docs.schema[n_chars].dataType)).otherwise(
            F.col(quoted(n_chars)))
    return got.select(*[new[c].alias(c) if c in new else F.col(quoted(c)) for c in docs.columns])


#: The result of query op4 in DuckDB.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source FROM documents),
l AS (SELECT r, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM d),
bad AS (SELECT trim(line, ' ') AS t FROM l WHERE trim(line, ' ') <> '' GROUP BY 1
        HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT l.*, bad.t IS NOT NULL AS b FROM l LEFT JOIN bad ON trim(l.line, ' ') = bad.t),
c AS (SELECT r, count(*) FILTER (trim(line, ' ') <> '') AS n_lines, count(*) FILTER (b) AS n_bad,
             coalesce(sum(length(trim(line, ' '))) FILTER (b), 0) < sum(length(trim(line, ' '))) AS act,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT b), '') AS kept FROM m GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(CASE WHEN act THEN n_bad ELSE 0 END AS BIGINT) AS n_removed,
       sha256(CASE WHEN act AND n_bad > 0 THEN kept ELSE coalesce(text, '') END) AS kept_sha256
FROM d JOIN c USING (r)
"""
