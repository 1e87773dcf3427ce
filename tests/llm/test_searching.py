"""Fill-in-the-middle, ranked lexical search and piece coding against brute force and the library."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidemark.llm import infill, lexical, pieces
from tidemark.plans.storage import scratch_dir

DOCS = "doc_id long, text string, n long, form string, output string, _row string, _text string, block long, segment long, term string"
LONG = "lorem ipsum\ndolor sit " * 20_000
CLASH = (7, "psm", "clash", "r", "t", 1, 2, "term")


def table(spark, rows):
    return spark.createDataFrame([(*row, *CLASH) for row in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [None, "", "\n", "\n\n", "one", "one\n", "a\nb", "a\n\nb\n", "<P>\nx", "x <M", "S>\n", "cut <\nP>\n<", "\r\n  é\n日本\n\U0001f600", LONG, LONG]
    texts += ["".join(rng.choices(["a", "Bc ", "\n", "<", "P>", "\\", "$1", "é", "\x00", " "], k=rng.randrange(60))) for _ in range(80)]
    return [*enumerate(texts), (3, "\n\n"), (None, "null\nid"), (None, None), (-4, "minus\n4\n")]


# 11 fill in the middle


def cut(doc_id, text, fim=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(part) for part in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in infill.MARKS) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("shares", [(100, 50), (60, 0), (0, 50), (100, 100)])
def test_cuts_equal_brute_force_and_texts_come_back(spark, rows, shares):
    found = infill.fill_in_middle(table(spark, rows), fim_percent=shares[0], spm_percent=shares[1])
    again = infill.restored(F.col("output"), F.col("form"))
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.select("_row.doc_id", F.col("_row.text").alias("text"), F.col("_row.form").alias("kept"), *names, again.alias("again")).collect()
    assert sorted(map(repr, ((r.doc_id, r.text, *(r[n] for n in names)) for r in got))) == sorted(repr((k, t, *cut(k, t, *shares))) for k, t in rows)
    assert all(r.again == (r.text or "") and r.kept == "psm" for r in got)


def test_infill_is_one_scan_of_built_in_functions(spark, rows, tmp_path):
    table(spark, rows).write.parquet(str(tmp_path / "d"))
    plan = infill.fill_in_middle(spark.read.parquet(str(tmp_path / "d")), keep=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    assert infill.fill_in_middle(table(spark, rows).limit(0)).count() == 0


def test_other_units_and_marks(spark):
    docs = spark.createDataFrame([(k, "ab cd  ef gh " * k) for k in range(20)], "doc_id long, text string")
    found = infill.fill_in_middle(docs, unit=r" *[^ ]+| +", marks=("[PRE]", "[SUF]", "[MID]"))
    text = infill.restored(F.col("output"), F.col("form"), ("[PRE]", "[SUF]", "[MID]"))
    got = found.select(F.col("_row.text").alias("text"), text.alias("again"), "form", "n").collect()
    assert all(r.text == r.again for r in got) and {r.form for r in got} == {"plain", "psm", "spm"}
    assert all(r.n == len(re.findall(r" *[^ ]+| +", r.text)) for r in got)
    for marks in (("a", "ba", "c"), ("<P>", "<P>x", "<M>"), ("", "b", "c")):
        with pytest.raises(ValueError, match="mark"):
            infill.fill_in_middle(docs, marks=marks)


# 12 lexical search


def terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranked(docs, items, top):
    own = [(k, terms(t)) for k, t in docs]
    own = [(k, found) for k, found in own if found]
    n, length = len(own), sum(len(found) for _, found in own)
    out = []
    for item, text in items:
        wanted, scored = set(terms(text)), []
        df = {t: sum(t in found for _, found in own) for t in wanted}
        for k, found in own:
            m = 50 + (50 * len(found) * n) // length
            score = 0
            for t in wanted & set(found):
                tf = found.count(t)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, k is None, k or 0))
        out += [(item, rank, None if none else k, -score) for rank, (score, none, k) in enumerate(sorted(scored)[:top], start=1)]
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Über", "ÉTÉ", "naïve", "日本", "X-ray"]
    weights = [1 / (k + 1) for k in range(len(words))]
    return [" ".join(rng.choices(words, weights, k=rng.choice((1, 5, 20, 20, 80)))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    texts = corpus(1, 300)
    docs = [*enumerate(texts), *((1000 + k, t) for k, t in enumerate(texts[:40])), (7, texts[7]), (None, texts[3]), (None, None), (2000, ""), (2001, " .,!"), (2002, LONG)]
    items = [*enumerate(corpus(2, 12)), (5, "w1 w1 W2"), (None, "w3"), (90, None), (91, "..."), (92, "absent"), (93, "lorem w59 über")]
    return docs, items


@pytest.mark.parametrize("top,segment,block", [(5, 600, 4), (50, 16 << 20, 512), (10_000, 2000, 3), (1, 1, 1)])
def test_search_equals_brute_force(spark, library, monkeypatch, top, segment, block):
    docs, items = library
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    folder = scratch_dir(spark)
    questions = spark.createDataFrame([(k, t, "clash") for k, t in items], "item_id long, text string, term string")
    index, n = lexical.build_index(table(spark, docs), folder)
    segments = index.select("segment").distinct().count()
    assert segments == sum(1 for _, t in docs if terms(t)) if segment == 1 else segments > 10 if segment < 3000 else segments <= 3
    found = lexical.search(index, n, questions, folder, top).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, ranked(docs, items, top)))


def test_strata_beyond_reach_are_not_visited():
    strata = np.array([50, 60, 70])
    rich = lexical._Postings(1000, np.array([50, 50, 60, 70]), np.array([1, 3, 1, 1]), np.array([2, 2, 3, 3]), np.arange(10), strata)
    seen = []
    rich.adds = np.array(rich.adds)
    original = rich.stratum

    class Watched:
        def __getattr__(self, name):
            if name == "stratum":
                seen.append(1)
                return original
            return getattr(rich, name)

    hits, scores = lexical._best([Watched()], np.array([8, 3, 3]), 14, 2)
    assert len(seen) == 1  # the first stratum holds enough, and no other reaches its second score
    assert set(hits[scores == scores.max()].tolist()) == {2, 3}


def test_empty_index_and_items(spark, library):
    docs, items = library
    folder = scratch_dir(spark)
    index, n = lexical.build_index(table(spark, docs[:0] or []).limit(0), folder)
    questions = spark.createDataFrame(items, "item_id long, text string")
    assert (index.count(), n, lexical.search(index, n, questions, folder).count()) == (0, 0, 0)
    index, n = lexical.build_index(table(spark, docs), scratch_dir(spark))
    assert lexical.search(index, n, questions.limit(0), scratch_dir(spark)).count() == 0


# 13 pieces


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def strings(seed, n):
    rng = random.Random(seed)
    parts = [" ", "  ", "▁", "a", "the", "\n", "\t", "é", "☃", "<s>", "</s>", "\x00", "　", "\U0001f600", "word", ".", "1", "́"]
    return ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("block", [200, 16 << 20])
def test_piece_coding_equals_the_library(spark, rows, model, monkeypatch, block):
    monkeypatch.setattr(pieces, "BLOCK_BYTES", block)
    monkeypatch.setattr(pieces, "BUCKET_BYTES", 4 * block)
    data = [*rows, *((500 + k, t) for k, t in enumerate(strings(3, 800))), (900, " "), (901, "   "), (902, "a "), (903, " a")]
    if block == 200:
        data = [row for row in data if row[1] != LONG]
    found = pieces.encode_documents(table(spark, data), scratch_dir(spark)).collect()
    want = [(k, model.encode(t or "", add_eos=True), model.decode(model.encode(t or "", add_eos=True))) for k, t in data]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_piece_coding_of_nothing_and_without_end_id(spark, rows, model):
    assert pieces.encode_documents(table(spark, rows).limit(0), scratch_dir(spark)).count() == 0
    few = table(spark, [(1, "no end"), (2, None)])
    found = pieces.encode_documents(few, scratch_dir(spark), end_id=False).collect()
    assert sorted((r.doc_id, r.ids, r.decoded) for r in found) == [(1, model.encode("no end"), "no end"), (2, [], "")]
    assert not spark.catalog.listTables()


def test_every_distinct_chunk_is_segmented_once(spark, tmp_path):
    """Over all blocks, the chunks that buckets receive are distinct within a block, and a chunk goes to one bucket."""
    docs = table(spark, [(k, t) for k, t in enumerate(strings(4, 300))])
    blocks = pieces._blocks(docs, 5).select("block", F.inline("chunks")).collect()
    where = {}
    for r in blocks:
        packed = pieces.unpack(r.packed)
        ends = np.cumsum(packed["lengths"]).tolist()
        data = packed["data"].tobytes()
        chunks = [data[a:b] for a, b in zip([0, *ends], ends)]
        assert chunks == sorted(set(chunks))
        for chunk in chunks:
            assert where.setdefault(chunk, r.bucket) == r.bucket == pieces.bucket_of(chunk, 5)


# registered queries


@pytest.mark.parametrize("name", ["op11_infill", "op12_lexical"])
def test_registered_query_matches_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for view in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    found = contract.queries()[name](spark, sf_dir)
    columns = ", ".join(found.columns)
    want = con.sql(f"SELECT {columns} FROM ({contract.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, want))


def test_registered_piece_coding_equals_the_library(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: r for r in contract.queries()["op13_pieces"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        ids = model.encode(doc.text, add_eos=True)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        r = found[doc.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids)))
