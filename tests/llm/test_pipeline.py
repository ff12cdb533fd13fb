import random
import re

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from eventwatch.llm import bpe, decontam, langid, lines, simhash
from eventwatch.llm.common import words
from fixtures import SCHEMA, frame, prose, rows

SF = "/root/testdata/sf0.001"


def ngrams(text):
    """Bytes of a text once its words are one space apart and set in spaces."""
    return len(re.sub(rb"[^a-z\x80-\xff]+", b" ", f" {text.lower()} ".encode()))


def sites_rows():
    """Pages under a bar that twelve sites carry: long ones, short ones, the bar alone, and texts without an n-gram."""
    bar = "lorem ipsum dolor sit amet\nconsectetur adipiscing elit sed do eiusmod tempor"
    rnd, made = random.Random(3), []
    for i in range(36):
        own = prose(rnd, (30, 2, 6)[i % 3])
        made.append((1000 + i, f"{bar}\n{own}", "en", f"s{i % 12}", 1, "x", "y"))
    made += [(1100 + i, bar, "en", f"s{i}", 1, "x", "y") for i in range(12)]
    return made + [(1200, "Re.", None, "s1", 3, "x", "y"), (1201, "é", None, "s2", 1, "x", "y"), (1202, "½ ² Ⅷ", "en", "s2", 5, "x", "y")]


def plain(spark, docs, bench):
    """The stages in plain Python; the language model is trained by the operator."""
    model = langid.fit_on_training_rows(spark.createDataFrame(docs, SCHEMA))
    docs = [d for d in docs if (p := model.predict(d[1]))[0] != "und" and (p[2] >= langid.REJECT_EVIDENCE or ngrams(d[1]) < langid.GRAM)]
    sites = {}
    for d in docs:
        for x in d[1].split("\n"):
            if x.strip(" ") and d[3] is not None:
                sites.setdefault(x.strip(" "), set()).add(d[3])
    bad, cut = {x for x, s in sites.items() if len(s) >= lines.MIN_SITES}, []
    for d in docs:
        ls = [x.strip(" ") for x in d[1].split("\n")]
        gone = sum(len(x) for x in ls if x in bad)
        act = 0 < gone < sum(map(len, ls))  # a text of nothing but boilerplate stays whole
        cut.append((d[0], "\n".join(x for x in d[1].split("\n") if not act or x.strip(" ") not in bad), d[2]))
    fps = {}
    for d in cut:
        fps.setdefault(simhash.fingerprint(d[1].encode()), []).append(d)
    todo, groups = set(fps), []
    while todo:
        group, front = set(), [todo.pop()]
        while front:
            f = front.pop()
            group.add(f)
            near = {g for g in todo if bin(f ^ g).count("1") <= 3}
            todo -= near
            front += near
        groups.append(min((d for f in group for d in fps[f]), key=lambda d: (d[0] is None, d[0] or 0, d[1])))
    auto, out = decontam.Automaton([(i, words((t or "").encode())) for i, t in bench], 10), {}
    peer = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.load_ranks(P.path("byte_bpe_50k.tiktoken"))), special_tokens={})
    for i, t, lang in groups:
        n, runs, _ = auto.scan(t.encode())
        if sum(b - a for a, b in runs) <= decontam.MAX_COVERAGE * n:
            while runs:
                t = decontam.cut(t.encode(), runs).decode()
                runs = auto.scan(t.encode())[1]
            out[i] = (t, lang, len(peer.encode_ordinary(t)))
    return out


@pytest.mark.parametrize("kind", ["given", "odd"])
def test_run_equals_plain_python(spark, tmp_path, kind):
    if kind == "given":
        sf = SF
        docs = [(*r, None, None) for r in duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{sf}/documents.parquet'").fetchall()]
    else:
        sf, docs = str(tmp_path), [r for r in rows() if r[0] is not None] + sites_rows()
        frame(spark, docs).write.parquet(f"{sf}/documents.parquet")
        pq.write_table(pa.table({"item_id": pa.array([1, None], pa.int64()), "text": [" ".join(docs[12][1].split()[:12]), None]}), f"{sf}/benchmark.parquet")
    bench = duckdb.sql(f"SELECT item_id, text FROM '{sf}/benchmark.parquet'").fetchall()
    got = {r.doc_id: (r.text, r.lang, r.n_tokens) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == plain(spark, docs, bench)
    if kind == "odd":  # both rules were needed: bars cut from pages of mostly bars, bars alone kept, texts without an n-gram kept
        assert sum(i is not None and 1000 <= i < 1036 and "consectetur adipiscing elit sed" not in t for i, (t, _, _) in got.items()) > 20
        assert {1100, 1200, 1201} <= set(got) and 1202 not in got


def test_stages_keep_the_columns(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
    assert corpus_pipeline.encode(spark, docs, SF).columns == [*docs.columns, "n_tokens", "ids_sha256", "decoded_sha256"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "byte-level BPE"]
