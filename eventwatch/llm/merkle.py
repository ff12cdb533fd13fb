"""Merkle manifest of a dataset: a tree of digests per group of rows, one tree over the groups, and proofs per row.

A leaf is the SHA-256 of a row's fields (``-`` for null, else UTF-8 byte count, ``:``, value). Within a group, leaves stand in
order; every ``ARITY`` consecutive nodes become the digest of their concatenated hex digests (a last run may be shorter, even
one), until one is left: the group's subroot. Subroots in order of the group (null first, bytewise) make the root likewise.

1. Places. Narrow rows (order, group, digests) are dealt out by range and numbered within their partition; one small row
   per partition and group, summed up in order, turns that into the place within the group. So a group of a third of all
   rows is never sorted or numbered by one task.
2. Levels. ``SPAN`` levels at a time are one aggregation and a table in the checkpoint folder. A stored row is a page: the nodes
   of ``ARITY ** SPAN`` neighbours and of the levels between them and their common node, with a link to the page and place that
   this node has on the next level (in the top tree, for a subroot). Levels of few nodes, by an exact count, take one task.
3. Climb. A recursive query starts with every leaf's own digest (the original's or a changed row's), joins the page that it
   stands in, level by level records the other members of its run as siblings and folds them with what came up, and goes
   on at the page's link until there is none. A step shuffles some 60 bytes a row; siblings are emitted once a step and
   put together by one aggregation at the end.

Defined cases: null order values come first; rows of equal order stand by their digests, so equal rows are interchangeable;
null groups are a group; null and empty fields differ (``-`` and ``0:``); very long texts are only hashed, where they are read;
a lone leaf is its group's subroot, a lone subroot the root, and a proof without siblings is the digest of nothing; an empty
table gives no rows. Only the named columns enter a leaf: extra columns of any name are neither read nor carried.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventwatch.config import materialize
from eventwatch.llm.common import quoted

ARITY = 3
SPAN = 3            # levels of a page
_WIDTH = ARITY ** SPAN
_TOP = -1           # number of the tree over the subroots
_LEVEL = 48         # a slot is step << 48 | page
_FEW = 20_000       # nodes that one task aggregates
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def field(value: Column) -> Column:
    """A field as it enters a leaf."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """Digest (32 bytes) of a row's fields."""
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def hex_digest(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _above(nodes: Column) -> Column:
    """The next level over neighbouring nodes."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / ARITY).cast("int") - 1)
    text = lambda r: F.array_join(F.transform(F.slice(nodes, r * ARITY + 1, ARITY), hex_digest), "")
    return F.transform(runs, lambda r: F.unhex(F.sha2(F.encode(text(r), "utf-8"), 256)))


def placed(df: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """A written table of ``df`` plus ``seq`` (a number of the row), and its blocks: (part, group, first, before, n), from which
    the place of a row within its group is ``before + seq - first`` where ``part`` is ``seq >> 33``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    rows = materialize(df.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn("seq", F.monotonically_increasing_id()))
    blocks = (rows.groupBy(F.shiftright("seq", 33).alias("part"), *group)
              .agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("c")))
    # one row a partition and group: a group has at most as many as there are partitions
    all_ = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("c").over(all_.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    return rows, materialize(blocks.withColumn("before", before).withColumn("n", F.sum("c").over(all_)).drop("c"))


def _levels(nodes: DataFrame, sizes: DataFrame, up_tree: Column, up_slot: Column, up_place: Column) -> tuple[list[DataFrame], list[DataFrame]]:
    """Nodes (tree, pos, digest, n of the tree) -> tables of pages, and of last nodes (tree, digest), step by step. The last
    page of a tree links to what ``up_...`` say of its tree. ``sizes`` holds every tree's n."""
    pages, tops, step = [], [nodes.where("n = 1").select("tree", "digest")], 0
    page, last = F.col("page"), F.col("n") == 1
    n = F.col("n").cast("decimal(38,0)")
    while True:
        left = F.ceil(n / F.lit(_WIDTH ** step))
        count = sizes.select(left.alias("k")).where("k > 1").agg(F.sum("k")).first()[0]
        if not count:
            return pages, tops
        height = sum([F.when(F.col("n") > ARITY ** i, 1).otherwise(0) for i in range(SPAN)], F.lit(0))
        some = nodes.where("n > 1")
        made = ((some.coalesce(1) if count <= _FEW else some)
                .groupBy("tree", F.floor(F.col("pos") / _WIDTH).alias("page"), "n")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("parts"))
                .select("tree", "page", F.ceil(F.col("n") / _WIDTH).alias("n"), height.alias("height"),
                        F.transform("parts", lambda x: x["digest"]).alias("l0")))
        for i in range(SPAN):  # above a tree's last node there is nothing
            made = made.withColumn(f"l{i + 1}", F.when(F.col("height") > i, _above(F.col(f"l{i}"))).otherwise(F.col(f"l{i}")))
        made = materialize(made.withColumn("digest", F.col(f"l{SPAN}")[0]))
        pages.append(made.select(
            "tree", F.lit(step << _LEVEL).bitwiseOR(page).alias("slot"), "height", F.array(*[f"l{i}" for i in range(SPAN)]).alias("nodes"),
            F.when(last, up_tree).otherwise(F.col("tree")).alias("up_tree"),
            F.when(last, up_slot).otherwise(F.lit((step + 1) << _LEVEL).bitwiseOR(F.floor(page / _WIDTH))).alias("up_slot"),
            F.when(last, up_place).otherwise((page % _WIDTH).cast("int")).alias("up_place")))
        nodes = made.select("tree", F.col("page").alias("pos"), "digest", "n")
        tops.append(nodes.where("n = 1").select("tree", "digest"))
        step += 1


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@contextmanager
def _no_row_limit(spark: SparkSession) -> Iterator[None]:
    """A recursive query may return any number of rows."""
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        yield
    finally:
        spark.conf.unset(ROW_LIMIT) if before is None else spark.conf.set(ROW_LIMIT, before)


def _climb_sql() -> str:
    """The climb over the views leaves (seq, tree, slot, place, digest) and pages."""
    own = f"CAST(FLOOR(c.place / POW({ARITY}, l)) AS INT)"
    run = f"SLICE(p.nodes[l], {own} - {own} % {ARITY} + 1, {ARITY})"
    mine = f"ARRAY_JOIN(TRANSFORM({run}, (x, i) -> LOWER(HEX(IF(i = {own} % {ARITY}, a.digest, x)))), '')"
    others = f"ARRAY_JOIN(TRANSFORM({run}, (x, i) -> IF(i = {own} % {ARITY}, '', HEX(x))), '')"
    return f"""
        WITH RECURSIVE climb (seq, tree, slot, place, digest, step, siblings) AS (
            SELECT seq, tree, slot, place, digest, 0, X'' FROM {{leaves}}
            UNION ALL
            SELECT seq, up_tree, up_slot, up_place, up.digest, step + 1, up.siblings FROM (
                SELECT c.seq, p.up_tree, p.up_slot, p.up_place, c.step, AGGREGATE(
                    SEQUENCE(0, p.height - 1), NAMED_STRUCT('digest', c.digest, 'siblings', X''),
                    (a, l) -> NAMED_STRUCT('digest', UNHEX(SHA2(ENCODE({mine}, 'utf-8'), 256)),
                                           'siblings', CONCAT(a.siblings, UNHEX({others})))) AS up
                FROM climb c JOIN {{pages}} p ON c.tree = p.tree AND c.slot = p.slot)
        )
        SELECT seq, step, siblings, IF(tree IS NULL, digest, NULL) AS folded FROM climb"""


def manifest(df: DataFrame, columns: list[str], order_col: str = "doc_id", group_col: str = "source",
             changed: dict[str, Column] | None = None) -> DataFrame:
    """Per row of ``df``: its order and group columns (as ``id``, ``grp``), and 32-byte digests ``leaf``, ``subroot``, ``root``,
    ``proof`` (of its siblings' hex texts from the leaf's run up to the root's) and ``folded``, the root that comes out if the row
    had the values ``changed`` of some columns instead, by the original siblings."""
    spark = df.sparkSession
    original = [F.col(quoted(c)) for c in columns]
    other = [(changed or {}).get(c, F.col(quoted(c))) for c in columns]
    narrow = materialize(df.select(F.col(quoted(order_col)).alias("id"), F.col(quoted(group_col)).cast("string").alias("grp"),
                                   leaf(original).alias("leaf"), leaf(other).alias("now")))
    rows, blocks = placed(narrow, ["grp"], ["id", "leaf"])
    groups, spans = placed(blocks.groupBy("grp").agg(F.max("n").alias("n")), [], ["grp"])
    span = spans.select("part", "first", "before", F.col("n").alias("trees"))
    groups = (groups.withColumn("part", F.shiftright("seq", 33)).join(span, "part")
              .select(F.col("grp").alias("g"), "n", "trees", (F.col("before") + F.col("seq") - F.col("first")).alias("tree")))
    groups = materialize(groups)
    trees = groups.agg(F.max("trees")).first()[0]
    where = (blocks.drop("n").join(groups, F.col("grp").eqNullSafe(F.col("g"))).drop("g")
             .select(F.col("part").alias("p"), F.col("grp").alias("g"), "first", "before", "tree", "n", "trees"))
    on = (F.shiftright("seq", 33) == F.col("p")) & F.col("grp").eqNullSafe(F.col("g"))
    located = materialize(rows.join(where, on).select(
        "seq", "id", "grp", "leaf", "now", "tree", "n", "trees", (F.col("before") + F.col("seq") - F.col("first")).alias("pos")))

    many = F.lit((trees or 0) > 1)
    up = (F.when(many, F.lit(_TOP).cast("bigint")), F.when(many, F.floor(F.col("tree") / _WIDTH)),
          F.when(many, (F.col("tree") % _WIDTH).cast("int")))
    pages, tops = _levels(located.select("tree", "pos", F.col("leaf").alias("digest"), "n"), groups, *up)
    subroots = materialize(_union(tops).select("tree", F.col("digest").alias("subroot")))
    over = subroots.select(F.lit(_TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("subroot").alias("digest"),
                           F.lit(trees or 0).cast("bigint").alias("n"))
    end = [F.lit(None).cast(t) for t in ("bigint", "bigint", "int")]
    top_pages, roots = _levels(over, groups.select(F.col("trees").alias("n")).limit(1), *end)
    root = next((bytes(r[1]) for r in _union(roots).collect()), None)  # one digest; none of an empty table

    one = F.col("n") == 1
    start = located.select("seq", F.when(one, up[0]).otherwise(F.col("tree")).alias("tree"),
                          F.when(one, up[1]).otherwise(F.floor(F.col("pos") / _WIDTH)).alias("slot"),
                          F.when(one, up[2]).otherwise((F.col("pos") % _WIDTH).cast("int")).alias("place"), F.col("now").alias("digest"))
    if pages or top_pages:
        with _no_row_limit(spark):
            steps = materialize(spark.sql(_climb_sql(), leaves=start, pages=_union(pages + top_pages)))
    else:
        steps = start.select("seq", F.lit(0).alias("step"), F.lit(b"").alias("siblings"), F.col("digest").alias("folded"))
    path = F.array_sort(F.collect_list(F.struct("step", "siblings")))
    climbed = (steps.groupBy("seq").agg(path.alias("path"), F.max("folded").alias("folded"))
               .select("seq", "folded", F.array_join(F.transform("path", lambda s: hex_digest(s["siblings"])), "").alias("text")))
    return (located.join(climbed, "seq").join(subroots, "tree")
            .select("id", "grp", "leaf", "subroot", F.lit(root).cast("binary").alias("root"),
                    F.unhex(F.sha2(F.encode("text", "utf-8"), 256)).alias("proof"), "folded"))


#: The contract's digests: bottom-up levels and a climb per leaf, each as one recursive query.
ORACLE_FORM = r"""
WITH RECURSIVE
rows AS (
    SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text,
           CASE WHEN c % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS now
    FROM (SELECT *, {crc} AS c FROM documents)),
leaves AS (
    SELECT r, doc_id, source, sha256({head} || {text}) AS leaf, sha256({head} || {now}) AS changed FROM rows),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves),
levels(tree, level, pos, digest, n) AS (
    SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM levels WHERE n > 1 GROUP BY tree, level, pos // 3, n),
subroots AS (SELECT tree, digest FROM levels WHERE n = 1),
top(level, pos, digest, n) AS (
    SELECT 0, tree, digest, count(*) OVER () FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3
    FROM top WHERE n > 1 GROUP BY level, pos // 3, n),
nodes AS (
    SELECT tree, level, pos, digest FROM levels WHERE n > 1
    UNION ALL SELECT -1, level, pos, digest FROM top WHERE n > 1),
runs AS (
    SELECT tree, level, pos // 3 AS run, list(digest ORDER BY pos) AS parts FROM nodes GROUP BY ALL),
depth AS (SELECT tree, max(level) AS last FROM runs GROUP BY tree),
climb(r, own, tree, level, pos, digest, step, others) AS (
    SELECT r, tree, CASE WHEN tree IN (SELECT tree FROM depth) THEN tree ELSE -1 END, 0,
           CASE WHEN tree IN (SELECT tree FROM depth) THEN pos ELSE tree END, changed, 0, '' FROM placed
    UNION ALL
    SELECT r, own, CASE WHEN c.level = d.last AND c.tree >= 0 THEN -1 ELSE c.tree END,
           CASE WHEN c.level = d.last AND c.tree >= 0 THEN 0 ELSE c.level + 1 END,
           CASE WHEN c.level = d.last AND c.tree >= 0 THEN own ELSE c.pos // 3 END,
           sha256(concat(list_aggregate(parts[:c.pos % 3], 'string_agg', ''), digest, list_aggregate(parts[c.pos % 3 + 2:], 'string_agg', ''))),
           step + 1, concat(list_aggregate(parts[:c.pos % 3], 'string_agg', ''), list_aggregate(parts[c.pos % 3 + 2:], 'string_agg', ''))
    FROM climb c JOIN runs u ON c.tree = u.tree AND c.level = u.level AND c.pos // 3 = u.run JOIN depth d ON d.tree = c.tree),
ends AS (SELECT r, sha256(string_agg(others, '' ORDER BY step)) AS proof, arg_max(digest, step) AS folded FROM climb GROUP BY r)
SELECT doc_id, leaf, s.digest AS subroot, (SELECT digest FROM top WHERE n = 1) AS root, proof AS proof_sha256,
       folded AS folded_root, folded = (SELECT digest FROM top WHERE n = 1) AS verified
FROM placed JOIN ends USING (r) JOIN subroots s USING (tree)
"""


def _oracle() -> str:
    part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    bits = "list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))"  # CRC-32, a byte
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, x: {bits}), 4294967295)"
    head = " || ".join(map(part, ("doc_id", "source", "lang", "n_chars")))
    return ORACLE_FORM.format(crc=crc, head=head, text=part("text"), now=part("now"))


ORACLE = _oracle()
