import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from eventwatch.llm import merkle
from conftest_sql import oracle_rows
from fixtures import SCHEMA, empty, frame, rows

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """The last node, and per leaf its siblings' texts, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            b = a // 3 * 3
            paths[i].append(("".join(nodes[b:a]), "".join(nodes[a + 1:b + 3])))
            at[i] = a // 3
        nodes = [sha("".join(nodes[b:b + 3])) for b in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute_force(docs, change):
    by = {}
    for i, text, lang, source, n, *_ in docs:
        head = "".join(map(field, (i, source, lang, n)))
        by.setdefault(source, []).append(((i is not None, i or 0), sha(head + field(text)), sha(head + field(change(i, text))), i))
    trees = {s: (sorted(ls), tree([r[1] for r in sorted(ls)])) for s, ls in by.items()}
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, above = tree([trees[s][1][0] for s in order])
    out = []
    for s, up in zip(order, above):
        ls, (sub, paths) = trees[s]
        for (_, leaf, now, i), p in zip(ls, paths):
            for left, right in p + up:
                now = sha(left + now + right)
            out.append((i, leaf, sub, root, sha("".join(a + b for a, b in p + up)), now))
    return sorted(out, key=str)


def got(df, **kw):
    rows_ = merkle.manifest(df, COLUMNS, **kw).select("id", *[F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")]).collect()
    return sorted(map(tuple, rows_), key=str)


def test_odd_rows(spark):
    no_end = F.translate("text", "\n", "")
    assert got(frame(spark), changed={"text": no_end}) == brute_force(rows(), lambda i, t: None if t is None else t.replace("\n", ""))
    assert got(empty(spark)) == []


@pytest.mark.parametrize("sizes", [[1], [1, 1], [10, 1, 1, 28]])
def test_shapes(spark, sizes):
    docs = [(i, f"text {i} of {s}\n", "en", None if s == 0 else f"s{s}é", 1, "x", "y") for s, n in enumerate(sizes) for i in range(n)]
    assert got(spark.createDataFrame(docs, SCHEMA)) == brute_force(docs, lambda i, t: t)


def test_a_change_shows_only_in_its_row(spark):
    docs = [(i, f"t{i}", "en", "s", 1, "x", "y") for i in range(20)]
    made = merkle.manifest(spark.createDataFrame(docs, SCHEMA), COLUMNS,
                           changed={"text": F.when(F.col("doc_id") == 7, "other").otherwise(F.col("text"))})
    assert [r.id for r in made.where("folded <> root").collect()] == [7]


def test_session_setting_is_given_back(spark):
    before = spark.conf.get(merkle.ROW_LIMIT, None)
    got(frame(spark))
    assert spark.conf.get(merkle.ROW_LIMIT, None) == before


def test_query_equals_sql_and_brute_force(spark):
    have, want = oracle_rows(spark, "op12_merkle")
    assert have == want and len(have) == 200
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    plain = brute_force(docs, lambda i, t: t.replace("\n", "") if t and zlib.crc32(str(i).encode()) % 2 == 0 else t)
    from eventwatch.llm import queries
    made = queries.op12_merkle(spark, "/root/testdata/sf0.001").select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").collect()
    assert sorted(map(tuple, made), key=str) == plain
