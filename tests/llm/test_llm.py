"""Every operator of the training-data package on small hand-made tables: brute force, round trips and odd rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import bpe, common, components, edits, html, mixing, quality, rules, simhash, tokens, urls, warc
from tidemark.plans.storage import scratch_dir, store

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, size long, kept boolean, _row string"
WORD = r"[^\x20\x09-\x0D]+"
LONG = "lorem ipsum dolor " * 20_000


def prose(seed: int, n: int = 120) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(("the", "of", "and", "tion", "er")) if rng.random() < 0.4 else "".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Texts with nulls, empties, ties, repeats, long ones and clashing extra columns."""
    base = prose(1)
    texts = [base, base, base.replace("tion", "TION", 1), prose(2), prose(3), None, "", " \n\t", "one", "one two", LONG, "the the the " * 60]
    texts += [prose(k) for k in range(10, 30)] + ["É café 日本 <|endoftext|> don't\r\n  x", "a\u00a0b"]
    data = [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, -1, "clash", 7, True, "r") for k, t in enumerate(texts)]
    return [*data, data[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op1_mixing", "op7_urls"])
def test_registered_query_matches_sql(spark, sf_dir, duck, name):
    got = contract.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    want = duck.sql(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(want, key=str)


def test_all_queries_are_registered():
    numbers = {int(m[1]) for name in contract.queries() if (m := re.match(r"op(\d+)_", name))}
    assert numbers == set(range(1, 14)) and "pipeline" in contract.queries()


# 1 mixing


def shares(sizes, weights, cap=3):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else left * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over or len(full | over) == len(names):
            return target
        full |= over


def test_targets_equal_repeated_resharing(spark):
    rng = random.Random(5)
    for _ in range(6):
        sizes = {f"s{k}": rng.choice((0, 1, 5, 50, 5000)) for k in range(7)} | {None: 20}
        found = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
        want = shares(sizes, (5, 2, 1))
        assert {r.source: r.source_size for r in found} == sizes
        assert all(abs(r.target - want[r.source]) < 1e-6 * (1 + want[r.source]) for r in found)


def test_mix_is_near_its_targets_and_repeats_itself(spark, docs, rows, empty):
    found = mixing.mix(docs, scratch_dir(spark), ["doc_id"]).select("_row.doc_id", "source", "size", "source_size", "target", "copies").collect()
    again = mixing.mix(docs.repartition(5), scratch_dir(spark), ["doc_id"]).select("_row.doc_id", "source", "size", "source_size", "target", "copies").collect()
    assert sorted(found, key=str) == sorted(again, key=str)
    assert len(found) == len(rows)
    assert collections.Counter((r.doc_id, r.size) for r in found) == collections.Counter((r[0], len(re.findall(WORD, r[1] or ""))) for r in rows)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= max(r.size for r in own) + 1e-6
        assert all(0 <= r.copies <= 3 for r in own)
    mixed = mixing.mixed(docs, scratch_dir(spark))
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == collections.Counter({k: n for k in {r.doc_id for r in found} if (n := sum(r.copies for r in found if r.doc_id == k))})
    assert mixing.mix(empty, scratch_dir(spark), ["doc_id"]).count() == 0


# 2 html


def test_blocks_follow_the_markup():
    page = "<p>a&amp;b <b>c<br>d<p>e\n f</p><ul><li>x<li>y</ul><script>if(a<b){'</p>'}</script><!-- <p>no --><div hidden>h</div>1 < 2<td"
    assert [b.text for b in html.blocks_of(page)] == ["a&b c d", "e f", "x", "y", "h", "1 < 2"]
    assert html.main_text("", {}) == "" and html.main_text("<nav>menu</nav>", {}) == ""


@pytest.mark.parametrize("head", ["<head>", "<head><title>t</title><meta charset=x><style>s</style>", "<head><template><p>no</p></template><script>x</script>"])
@pytest.mark.parametrize("body", ["<body><p>a<p>b</body>", "<p>a<p>b", "</body><p>a<p>b", "a<p>b", "<b>a</b><p>b", "&#97;<head><p>b", "</head>a<body><p>b"])
def test_an_open_head_ends_with_the_body(head, body):
    assert [b.text for b in html.blocks_of(f"<html>{head}\n {body}")] == ["a", "b"]


def test_main_text_leaves_the_surroundings_out():
    page = (
        "<body><header class=site><a href=/>Home</a></header><nav><ul><li><a href=/a>A</a></ul></nav><div class='cookie-notice'>We use cookies.</div>"
        "<main><article><header><h1>Title</h1></header><p>First &eacute; paragraph.</p><div class=ad>Buy</div><form><label>Mail</label></form>"
        "<p>Second\u00a0 one.</p><footer>By me</footer></article><aside>Also read</aside></main>"
        "<section id=comments><article class=comment><p>Nice text, I like it very much.</p></article></section><footer>&copy; us</footer>"
    )
    assert html.main_text(page, {}) == "Title\nFirst é paragraph.\nSecond one."


STORY = "<h2>A town</h2>" + "".join(f"<p>The {w} rose again in spring, and the town moved its market to the hill above the old bridge.</p>" for w in ("river", "lake", "sea"))
AROUND = (
    '<nav><a href=x>Home</a> <a href=y>News</a></nav><div class="sidebar"><a href=z>More stories</a> Popular today</div>'
    "<footer>© 2020 Site. All rights reserved.</footer>"
)
SHAPES = {
    "wrapper named after its sidebar": f'<body><div class="layout right-sidebar">{AROUND}<div>{STORY}</div></div>',
    "wrapper around an article": f'<body><div class="layout right-sidebar">{AROUND}<article>{STORY}</article></div>',
    "article of a category": f'<body>{AROUND}<article class="post category-advertising">{STORY}</article>',
    "article with sharing": f'<body>{AROUND}<article class="story share-enabled">{STORY}</article>',
    "search page": f'<body><div id="search-page">{AROUND}<div>{STORY}</div></div>',
    "page in a form": f"<body><form id=aspnetForm>{AROUND}<div>{STORY}</div></form>",
    "many comments": f'<body>{AROUND}<article>{STORY}</article><div class="comments"><h3>Comments</h3>'
    + '<div class="comment"><p>I liked this story a lot, and my mother told me of the old market too.</p></div>' * 12
    + "</div>",
    "advert inside": f'<body>{AROUND}<article>{STORY}<div class="ad"><a href=u>Buy now</a> cheap shoes</div></article>',
    "button outside": f"<body>{AROUND}<main>{STORY}</main><button>Share</button>",
}


@pytest.fixture(scope="module")
def text_model(spark):
    return html.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("shape", SHAPES)
def test_names_of_frames_do_not_lose_the_article(text_model, shape):
    lines = html.main_text(SHAPES[shape], text_model).split("\n")
    assert lines[0] == "A town" and len(lines) == 4 and all(line.endswith("old bridge.") for line in lines[1:])


def test_the_cut_outweighs_a_name(text_model):
    """A quotation whose class is in the list stays between paragraphs, as its text and neighbours say more; so do words of buttons."""
    quote = "<blockquote class=social>She said that the old bridge had carried three generations of farmers.</blockquote>"
    page = f"<body>{AROUND}<article>{STORY}{quote}<p>Use <button>Save</button> to keep the page, and go on with the next one.</p></article>"
    assert any(b.structure < 0 and b.text.startswith("She said") for b in html.blocks_of(page))
    lines = html.main_text(page, text_model).split("\n")
    assert lines[-2].startswith("She said") and lines[-1].startswith("Use Save to keep")
    assert "She said" not in html.main_text(f"<body><div class=sidebar>{quote}<a href=x>More</a></div><article>{STORY}</article>", text_model)


def test_minimum_cut_equals_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        n = rng.randint(1, 8)
        scores = [rng.randint(-9, 9) for _ in range(n)]
        edges = {(a, b): rng.randint(1, 6) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.4}

        def cost(side):
            own = sum(-s if s < 0 else 0 for s, inside in zip(scores, side) if inside) + sum(s if s > 0 else 0 for s, inside in zip(scores, side) if not inside)
            return own + sum(w for (a, b), w in edges.items() if side[a] != side[b])

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))
        assert cost(html.minimum_cut(scores, edges)) == best


def test_extract_handles_odd_pages(spark):
    pages = [(1, "u", None, "x"), (2, None, "", "x"), (2, None, "", "x"), (3, "v", "<article><p>ok " + "<i>deep " * 3000 + "</article>", "x"), (None, "w", "<p", "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    found = html.extract(table, html.train(table)).collect()
    assert sorted((str(r.page_id), r.text[:7]) for r in found) == [("1", ""), ("2", ""), ("2", ""), ("3", "ok deep"), ("None", "")]
    assert html.extract(table.limit(0), {}).count() == 0


# 3 tokens


def test_wavelet_access_count_locate():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = rng.integers(0, 200, n).astype(np.int32)
        doc_ids, offsets, matrix = tokens.read_shard(b"".join(tokens.shard_bytes(np.array([5, 7]), np.array([n // 3, n - n // 3]), ids, 8)))
        assert (matrix.decode() == ids).all() and doc_ids.tolist() == [5, 7] and offsets.tolist() == [0, n // 3, n]
        assert all(matrix.access(k) == ids[k] for k in range(0, n, 37))
        for value in (0, 3, 199, 7000):
            places = np.flatnonzero(ids == value)
            assert matrix.count(value, n // 4, n) == (places >= n // 4).sum()
            assert [matrix.locate(value, k) for k in range(0, len(places), 3)] == places[::3].tolist()
            with pytest.raises(IndexError):
                matrix.locate(value, len(places))
    with pytest.raises(ValueError):
        tokens.read_shard(b"".join(tokens.shard_bytes(np.array([5]), np.array([3]), np.array([1, 2, 3]), 8))[:-5] + b"12345")


def test_pieces_encode_like_the_library():
    codec, rng = tokens.PieceCodec(None), random.Random(2)
    alphabet = ["a", "b", "'s", "'", " ", "\n", "\u3000", "\u00a0", "é", "É", "İ", "Σ", "1", "23", "#", "<|endoftext|>", "€", "The", "\r", "日本", "\u0301", "😀", ",", "ﬁ", "\u212a"]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 12)))
        assert codec.encode(text.encode()).tolist() == codec.tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_of_several_texts_are_looked_up_once():
    """Texts together encode like each alone; a new piece is encoded once, however often they hold it."""
    codec, alone, rng = tokens.PieceCodec(None), tokens.PieceCodec(None), random.Random(3)
    texts = [None, "", " \n", "a\x0bb\x0cc\x1cd ", *["".join(rng.choices(["the", " ", "\n", "é,", "x.", "日", "1"], k=30)) for _ in range(200)]]
    for some in (texts, texts[:1], [*texts, "a <|endoftext|> b"]):
        found = [ids.tolist() for ids in codec.encode_all(pa.array(some, pa.string()))]
        assert found == [alone.encode((text or "").encode()).tolist() for text in some]
    made, piece = [], codec._piece
    codec._piece = lambda new: made.append(new) or piece(new)
    long = "n" * 100  # too long to be remembered
    codec.encode_all(pa.array([f"{long} {long}", long]))
    assert made == [long.encode()]


def test_shards_round_trip(spark, docs, rows, empty):
    folder = scratch_dir(spark)
    manifest = store(tokens.write_shards(docs, f"{folder}/shards", shard_tokens=500), folder, "manifest")
    read = tokens.read_shards(manifest).join(tokens.shard_starts(manifest, folder), "path").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for doc_id, text in sorted(((r[0], r[1] or "") for r in rows)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()), ids))
        start += len(ids)
    assert sorted((r.doc_id, r.start + r.local_start, r.n_tokens, r.ids_crc32, r.ids) for r in read) == want
    folder = scratch_dir(spark)
    manifest = store(tokens.write_shards(empty, f"{folder}/shards"), folder, "manifest")
    assert tokens.read_shards(manifest).count() == 0 and tokens.shard_starts(manifest, folder).count() == 0


def test_shards_take_rows_without_doc_id(spark):
    data = [(7, "one"), (None, "b c"), (None, None), (-3, "two"), (None, "b c"), (7, "")] + [(None, f"{k} more words") for k in range(40)]
    folder = scratch_dir(spark)
    table = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    manifest = store(tokens.write_shards(table, f"{folder}/shards", shard_tokens=12), folder, "manifest")
    read = tokens.read_shards(manifest).join(tokens.shard_starts(manifest, folder), "path").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, want = 0, []
    for doc_id, text in sorted(((k, t or "") for k, t in data), key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        want.append((start, doc_id, ids))
        start += len(ids)
    assert sorted(((r.start + r.local_start, r.doc_id, r.ids) for r in read), key=lambda r: r[0]) == want


# 4 quality


def test_classifier_holds_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("good"))
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    found = quality.classify(docs, seen, scratch_dir(spark), keep=["doc_id"]).select("_row.doc_id", "kept").join(held, "doc_id").collect()
    assert len(found) > 150
    assert np.mean([r.kept == bool(r.good) for r in found]) >= 0.98
    assert all(r.kept for r in found if r.good)


def _strength(counts):
    """The beta-binomial's strength, restated for pairs (k, n)."""
    k, n = sum(c[0] for c in counts), sum(c[1] for c in counts)
    rate, groups = k / n, len(counts)
    correlation = 0.5
    if groups > 1 and 0 < rate < 1:
        room = n - sum(c[1] ** 2 for c in counts) / n - (groups - 1)
        spread = sum(c[0] ** 2 / c[1] for c in counts) - n * rate * rate
        correlation = (spread / (rate * (1 - rate)) - (groups - 1)) / room if room > 0 else 0.5
    return 1 / min(0.5, max(0.001, correlation)) - 1


def test_posteriors_equal_a_plain_recomputation(spark, docs, rows):
    given = [(0, 1), (3, 1), (11, 0), (11, 1), (None, 1), (4, None), (20, 0)]
    labels = spark.createDataFrame(given, "doc_id long, good int")
    found = quality.classify(docs, labels, scratch_dir(spark), keep=["doc_id", "source", "lang"]).collect()
    base = quality.train(docs, labels).base
    own = lambda e: 1 / (1 + math.exp(-(e + base)))
    paths, hosts = {}, {}
    for r in found:
        told = [good for doc_id, good in given if good is not None and doc_id == r._row.doc_id]
        for table, key in ((paths, (r._row.source, r._row.lang)), (hosts, r._row.source)):
            k, n = table.get(key, (0.0, 0.0))
            table[key] = (k + own(r.evidence) + sum(told), n + 1 + len(told))
    prior = (sum(k for k, _ in hosts.values()) + 1) / (sum(n for _, n in hosts.values()) + 2)
    s_host, s_path = _strength(list(hosts.values())), _strength(list(paths.values()))
    for r in found:
        k, n = hosts[r._row.source]
        host = (max(k - own(r.evidence), 0) + s_host * prior) / (n - 1 + s_host)
        k, n = paths[r._row.source, r._row.lang]
        path = (max(k - own(r.evidence), 0) + s_path * host) / (n - 1 + s_path)
        want = 1 / (1 + math.exp(-(r.evidence + math.log(path / (1 - path)))))
        assert abs(r.host_posterior - host) < 1e-9 and abs(r.path_posterior - path) < 1e-9 and abs(r.posterior - want) < 1e-9
        assert r.kept == (r.posterior >= 0.5)
    whole = quality.classify(docs, labels, scratch_dir(spark)).collect()
    want = sorted((r._row.doc_id, r.posterior) for r in found)
    assert all(a == c and abs(b - d) < 1e-9 for (a, b), (c, d) in zip(sorted((r._row.doc_id, r.posterior) for r in whole), want))


def test_sparse_sites_shrink(spark):
    scored = [("big", "a", 6.0)] * 300 + [("big", "b", -6.0)] * 300 + [("bad", "a", -6.0)] * 200 + [("new", None, -6.0), (None, "a", 6.0)]
    table = spark.createDataFrame([(k, *row) for k, row in enumerate(scored)], "doc_id long, host string, path string, _evidence double")
    none = spark.createDataFrame([], "doc_id long, good int")
    sites = quality.site_outcomes(table, none, 0.0, scratch_dir(spark))
    rates = {(r.host, r.path): r for r in quality.with_posteriors(table, sites, 0.0).collect()}
    assert rates["big", "a"].path_posterior > 0.9 > 0.1 > rates["big", "b"].path_posterior
    assert rates["bad", "a"].host_posterior < 0.05
    assert abs(rates["new", None].host_posterior - sites.prior) < 1e-6  # its own text says nothing of its site
    assert abs(rates["new", None].path_posterior - sites.prior) < 1e-6


def test_classifier_on_odd_rows(spark, docs, rows, empty):
    labels = spark.createDataFrame([(0, 1), (3, 1), (11, 0), (11, 0), (None, 1), (4, None)], "doc_id long, good int")
    found = quality.classify(docs, labels, scratch_dir(spark)).collect()
    assert len(found) == len(rows) and all(0 <= r.posterior <= 1 and r.kept is not None for r in found)
    assert quality.accepted(docs, labels.limit(0), scratch_dir(spark)).columns == docs.columns
    assert quality.accepted(empty, labels, scratch_dir(spark)).count() == 0


# 5 edits


def likeness(a: str, b: str) -> float:
    return edits.shared_walk().compare(edits.Text(None, a).print, edits.Text(None, b).print)[1]


def test_few_edits_keep_texts_alike():
    text = prose(7, 900)
    assert likeness(text, text) == 1.0
    assert likeness(text, "x" + text) > 0.7 and likeness(text, text[:2000] + text[2010:]) > 0.7
    assert likeness(text, prose(8, 900)) < 0.35
    assert likeness("", "") == 1.0 and likeness("", text) == 0.0
    assert 0.5 < likeness(text, text[: len(text) * 2 // 3] + prose(9, 900)[: len(text) // 3]) < 0.85


def full_likeness(a: str, b: str) -> float:
    """The share of steps at which both whole walks write the same character."""
    one, other = (edits.Text(None, t) for t in (a, b))
    shown = [t.codes[np.searchsorted(t.ends, np.arange(t.ends[-1]), side="right")] for t in (one, other)]
    n = min(map(len, shown))
    return (shown[0][:n] == shown[1][:n]).sum() / max(map(len, shown))


def stepped(text):
    """The walk step by step: at each step it writes its character, and moves on if the shared random bit says so."""
    walk, out, place = edits.shared_walk(), [], 0
    codes = [ord(c) for c in text]
    while place < len(codes):
        code = codes[place]
        out.append(code)
        place += int(walk.moves[(len(out) - 1) % edits.PERIOD, (code ^ code >> 8 ^ code >> 16) & 0xFF])
    return out


@pytest.mark.parametrize("text", ["", "a", "é日本\U0001f600 x", prose(3, 40), prose(4, 400), prose(5, 3000)])
def test_fingerprint_equals_the_walk_step_by_step(text):
    walk, written = edits.shared_walk(), stepped(text)
    level = next(k for k in range(40) if len(written) <= edits.SAMPLES << k)
    bits = [int(walk.bits[(written[step] * 0x9E37 >> 4 ^ step) & 0xFFFF]) for step in walk.places[level].tolist() if step < len(written)]
    packed = bytes(sum(bit << 7 - k for k, bit in enumerate(bits[at : at + 8])) for at in range(0, len(bits), 8))
    assert edits.Text(None, text).print == f"{len(written)}:{packed.hex()}"


def test_levels_are_nested():
    walk = edits.shared_walk()
    for level in range(1, 20):
        within = walk.places[level][walk.places[level] < edits.SAMPLES << level - 1]
        assert set(within.tolist()) <= set(walk.places[level - 1].tolist()) and len(walk.places[level]) == edits.SAMPLES


@pytest.mark.parametrize("n,m", [(2048, 1024), (2049, 1024), (4097, 2048), (8200, 4090), (4096, 1030), (300, 100), (20_000, 5001), (60_000, 15_001), (900, 800)])
def test_likeness_has_no_jump(n, m):
    text = prose(12, 12_000)
    one, other = stepped(text[:n]), stepped(text[:m])
    whole = sum(a == b for a, b in zip(one, other)) / max(len(one), len(other))
    assert abs(likeness(text[:n], text[:m]) - whole) < 0.1 and likeness(text[:n], text[:m]) == likeness(text[:m], text[:n])


def test_texts_without_an_equal_band_are_no_candidates():
    bands, near = edits.shared_walk().compare(edits.Text(None, prose(1, 30_000)).print, edits.Text(None, "short").print)
    assert (bands, near) == (0, 0.0)


def test_many_rows_without_doc_id_are_spread(spark):
    texts = [prose(k, 30) for k in range(400)]
    docs = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    folder = scratch_dir(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = edits.fingerprint_edits(docs, folder).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(found) == 400 and {r.fingerprint for r in found} == {edits.Text(None, t).print for t in texts}
    assert spark.read.parquet(f"{folder}/ranges").select("part").distinct().count() > 1


def test_likeness_counts_the_longer_tail():
    text = prose(11, 30_000)
    for n, m in ((2048, 1024), (130_000, 65_536), (1500, 1000), (1025, 1024), (2000, 1100), (1024, 900)):
        assert abs(likeness(text[:n], text[:m]) - full_likeness(text[:n], text[:m])) < 0.1
        assert abs(likeness(text[:m], text[:n]) - m / n) < 0.1
    assert abs(edits.Text(1, text[:1500]).row(edits.Text(2, ""))[5] - 2 / 3) < 0.1


def test_fingerprints_of_edited_texts(spark, docs, rows, empty):
    found = edits.fingerprint_edits(docs, scratch_dir(spark)).collect()
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (-r[0], r[1]))
    want = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        k = len(text) // 3
        edited = text[: len(text) - k] + following[:k]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), edits.Text(None, text).print, edits.Text(None, edited).print))
    assert sorted(tuple(r)[:5] for r in found) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert edits.fingerprint_edits(empty, scratch_dir(spark)).count() == 0
    single = edits.fingerprint_edits(docs.where("doc_id = 4"), scratch_dir(spark)).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


# 6 warc


def test_archives_round_trip(spark):
    pages = [(3, "http://a/ b", "same"), (2, None, "same"), (2, None, "same"), (5, "u\r\nX: y", ""), (6, "v", None), (7, "w", "é\r\n\r\nWARC/1.1"), (None, "z", "same"), (8, "long", LONG)]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    folder = scratch_dir(spark)
    index = store(warc.write_archives(table, f"{folder}/archives", frame_bytes=700), folder, "index")
    read = warc.read_archives(warc.frames_of(index)).collect()
    assert len(read) == index.count() == len(pages)
    for r in read:
        payload = next((p[2] or "") for p in pages if p[0] == r.page_id).encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r.record_type == "response") == (r.page_id in (2, 5, 7, 8))
        assert r.refers_to == {3: 2, None: 2, 6: 5}.get(r.page_id)
        assert r.payload == (payload if r.record_type == "response" else None)
    one = warc.fetch(index, spark.createDataFrame([("<urn:page:7>",)], "record_id string")).collect()
    assert [bytes(r.payload).decode() for r in one] == ["é\r\n\r\nWARC/1.1"]
    folder = scratch_dir(spark)
    least = store(warc.write_archives(table, f"{folder}/archives", least_bytes=1), folder, "index")
    assert {r.record_type for r in warc.read_archives(warc.frames_of(least)).where("page_id in (5, 6)").collect()} == {"response"}
    none = store(warc.write_archives(table.limit(0), f"{folder}/none"), folder, "none")
    assert warc.read_archives(warc.frames_of(none)).count() == 0


# 7 urls


def test_url_parts_rules_and_reputation(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://Sub.EXAMPLE.net/en/x?y#z": ("sub.example.net", "/en/x", "example.net/en/", "allow"),
        "http://example.net": ("example.net", "", None, "allow"),
        "http://other.net/en/": ("other.net", "/en/", "net/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "https://a.example.com/de/q": ("a.example.com", "/de/q", "example.com/de/", "block"),
        "x://b.org/fr/1://c": ("b.org", "/fr/1://c", "org/fr/", "allow"),
        "http://h?p/q": ("h", "", None, "allow"),
        "http://bad.test/1": ("bad.test", "/1", None, "block"),
    }
    pages = [(k, url) for k, url in enumerate(cases)] + [(100 + k, "http://bad.test/x") for k in range(60)] + [(300 + k, "http://good.test/x") for k in range(60)]
    outcomes = [(100 + k, 1) for k in range(60)] + [(300 + k, 0) for k in range(60)] + [(1, None), (None, 1)]
    found = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int"), scratch_dir(spark)).collect()
    assert len(found) == len(pages)
    by_id = {r.page_id: r for r in found}
    for k, want in enumerate(cases.values()):
        assert (by_id[k].host, by_id[k].path, by_id[k].rule, by_id[k].verdict) == want
    assert by_id[300].verdict == "allow" and by_id[100].verdict == "block"
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r.verdict for r in urls.judge(spark.createDataFrame(pages[-3:], "page_id long, url string"), none, scratch_dir(spark)).collect()} == {"allow"}


# 8 bpe


def test_coding_equals_the_library():
    codec, rng = bpe.Codec(), random.Random(1)
    alphabet = ["a", "b", "'s", "'", " ", "  ", "\n", "\t", "\u3000", "\u00a0", "é", "×", "1", "23", "#", "<|endoftext|>", "€", "the", "\r", "\x0b", "日本", "'ll", "\x00", "😀", "e\u0301", "é,"]
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        want = codec.tokenizer.encode(text, add_special_tokens=False).ids
        assert codec.encode(text.encode()).tolist() == want
        assert codec.decode(want) == codec.tokenizer.decode(want, skip_special_tokens=False)


def test_forced_cuts_lie_in_no_token():
    codec = bpe.Codec()
    tokens_of = codec.tokenizer.get_vocab()
    assert len(tokens_of) == 50_257
    for raw in codec.token_bytes.values():
        if raw not in codec.special:
            assert codec.fragments(raw) == [raw]


def test_encode_documents(spark, docs, rows, empty):
    found = bpe.encode_documents(docs).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in rows]
    assert sorted((r.doc_id, r.ids, r.decoded) for r in found) == sorted(want)
    assert bpe.encode_documents(empty).count() == 0


# 9 rules


def base_measures(text):
    found = re.findall(WORD, text)
    windows = list(zip(found, found[1:], found[2:]))
    times = collections.Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if times[w] > 1 for i in range(3)}
    lines = [line for line in text.split("\n") if re.search(WORD, line)]
    n = len(found)
    return n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_measures_equal_brute_force(spark, rows):
    rng = random.Random(4)
    texts = [r[1] for r in rows] + ["".join(rng.choices(["a ", "b ", "c ", "\n", "#x ", "\r\n", "é ", "\x0b"], k=rng.randint(0, 60))) for _ in range(150)]
    table = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    found = {r.k: tuple(r)[1:] for r in rules.measures(table).select("k", *columns).collect()}
    assert found == {k: base_measures(t or "") for k, t in enumerate(texts)}


def test_repeats_in_long_texts_and_among_like_hashes(spark, monkeypatch):
    a, b = 5 << 24, (5 << 24) + 1  # equal in the bits above the place
    table = spark.createDataFrame([([a, b, a, b],), ([b, a, 7, a],), ([a, b, 7, 8],), ([-a, 3, -a],)], "hashes array<long>")
    assert [r[0] for r in table.select(rules._repeated_places(F.col("hashes"), F.size(F.array_distinct("hashes")))).collect()] == [[0, 1, 2, 3], [1, 3], [], [0, 2]]
    monkeypatch.setattr(rules, "PLACE_BITS", 4)
    texts = [" ".join(random.Random(k).choices("abcd", k=k)) for k in range(10, 60)]
    found = rules.measures(spark.createDataFrame(list(enumerate(texts)), "k long, text string")).select("k", "n_repeat_words").collect()
    assert {r.k: r[1] for r in found} == {k: base_measures(t)[4] for k, t in enumerate(texts)}


@pytest.mark.parametrize("orders", [(1,), (1, 2)])
def test_ratio_equals_brute_force(spark, docs, rows, orders):
    trusted = spark.createDataFrame([(0,), (3,), (3,), (None,), (999,)], "doc_id long")
    found = rules.judge(docs, trusted, scratch_dir(spark), keep=["doc_id"], orders=orders).select("_row.doc_id", "score", "kept", "base_failed").collect()

    def spark_hash(words):
        """Each word's hash, then that of a gram and one word more: the gram is the seed's base, as Spark chains its arguments."""
        singles = [xxhash.xxh64_intdigest(word.encode(), 42) for word in words]
        gram = singles[0]
        for other in singles[1:]:
            gram = xxhash.xxh64_intdigest(other.to_bytes(8, "little"), xxhash.xxh64_intdigest(gram.to_bytes(8, "little"), 42))
        if len(words) < max(2, n_words_of):
            gram = xxhash.xxh64_intdigest(gram.to_bytes(8, "little"), 42) if n_words_of > 1 else gram
        return gram % rules.BUCKETS

    def grams(text):
        nonlocal n_words_of
        w, found = re.findall(WORD, text or ""), []
        for n_words_of in orders:
            found += [spark_hash(w[k : k + n_words_of]) for k in range(len(w))]
        return found

    n_words_of = 1
    raw = collections.Counter(g for r in rows for g in grams(r[1]))
    target = collections.Counter(g for r in rows if r[0] in (0, 3) for g in grams(r[1]))
    share = target.total() / raw.total()

    def ratio(g):
        return round(math.log((target[g] + 3) / (raw[g] * share + 3)), 5)

    want = {r[0]: np.mean([ratio(g) for g in grams(r[1])]) if grams(r[1]) else 0.0 for r in rows}
    assert len(found) == len(rows)
    for r in found:
        assert abs(r.score - want[r.doc_id]) < 1e-9 and r.kept == (not r.base_failed and r.score >= -0.25)


def test_word_order_counts(spark):
    """A shuffled copy of a trusted text scores lower than the text."""
    texts = [prose(k, 200) for k in range(20)]
    shuffled = [" ".join(random.Random(k).sample(t.split(), 200)) for k, t in enumerate(texts)]
    table = spark.createDataFrame(list(enumerate(texts + shuffled)), "doc_id long, text string")
    found = rules.judge(table, spark.range(20).withColumnRenamed("id", "doc_id"), scratch_dir(spark), keep=["doc_id"]).collect()
    score = {r._row.doc_id: r.score for r in found}
    assert all(score[k] > score[k + 20] for k in range(20))


def test_only_trusted_documents_move(spark):
    """The bit table lets every trusted id through and almost no other."""
    ids = spark.range(0, 3_000_000, 1000).select(F.col("id").alias("_id"))
    table = spark.range(-1000, 2_000_000)
    passed = table.where(rules._perhaps(ids, F.col("id")))
    assert passed.where("id % 1000 = 0 and id >= 0").count() == 2000
    assert passed.count() < 2000 + 1000


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_every_trusted_document_counts(spark, limit):
    """However many there are, and by either kind of join."""
    texts = spark.range(20_400).select("id", F.concat(F.lit("w"), F.col("id") % 7, F.lit(" v")).alias("text"))
    more = spark.createDataFrame([(None, "w0"), (None, None), (5, "again"), (99_999, "raw")], "id long, text string")
    trusted = spark.range(20_400).unionByName(spark.createDataFrame([(None,), (5,)], "id long")).withColumnRenamed("id", "doc_id")
    folder, before = scratch_dir(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        rules.ratios(texts.unionByName(more).withColumnRenamed("id", "doc_id"), trusted, folder)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    raw, target = (spark.read.parquet(f"{folder}/{name}").agg(F.sum(name)).first()[0] for name in ("raw", "target"))
    assert (raw, target) == (2 * 40_803, 2 * 40_801)


@pytest.mark.parametrize("stage", [rules.judge, rules.passing])
def test_plans_do_not_hold_the_ratios(spark, docs, stage):
    """The driver keeps the texts of plans: they name the table of ratios, and no operator's rows carry it either."""
    plan = stage(docs, spark.createDataFrame([(0,)], "doc_id long"), scratch_dir(spark))._jdf.queryExecution()
    assert len(plan.toString()) < 500_000
    assert "_listed" not in plan.executedPlan().toString().replace("lambda", "")


def test_rules_stage_filters_and_runs_no_python(spark, docs, empty, capsys):
    trusted = spark.createDataFrame([(0,)], "doc_id long")
    kept = rules.passing(docs, trusted, scratch_dir(spark))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {0, 1, 2, 3, 4}
    kept.explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
    assert rules.passing(empty, trusted, scratch_dir(spark)).count() == 0


# 10 simhash


def plain_simhash(text):
    words = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints):
    """Groups of fingerprints by brute force."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in root}


def test_near_duplicates_equal_brute_force(spark, docs, rows, empty):
    found = simhash.near_duplicates(docs, scratch_dir(spark)).select("doc_id", simhash.hex_print(F.col("fp")).alias("fp"), "component_id").collect()
    prints = {r[0]: plain_simhash(r[1]) for r in rows}
    root = classes_of(set(prints.values()))
    least = {}
    for doc_id, p in prints.items():
        least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    assert sorted(map(tuple, found)) == sorted((r[0], f"{prints[r[0]]:016x}", least[root[prints[r[0]]]]) for r in rows)
    once = simhash.one_of_each(docs, scratch_dir(spark))
    assert once.columns == docs.columns
    assert sorted(r.doc_id for r in once.collect()) == sorted(set(least.values()))
    assert simhash.one_of_each(empty, scratch_dir(spark)).count() == 0


def test_one_row_of_each_component(spark):
    """Whether rows share a doc_id, have none, or are equal."""
    a, b, c, d, e = (prose(k) for k in range(40, 45))
    data = [(None, a, "x"), (None, a, "y"), (None, b, "x"), (None, None, "x"), (5, c, "x"), (5, d, "x"), (5, d, "x"), (4, d, None), (9, e, "x"), (None, e, "x"), (0, "other words", None)]
    results = []
    for n in (1, 3):
        table = spark.createDataFrame(data[::n] + (data[1::n] + data[2::n] if n > 1 else []), "doc_id long, text string, lang string").repartition(n)
        results.append(sorted(map(tuple, simhash.one_of_each(table, scratch_dir(spark)).collect()), key=str))
    assert results[0] == results[1]
    fixed = [r for r in results[0] if r[1] != a]
    assert len(results[0]) == len(fixed) + 1
    assert fixed == sorted([(None, b, "x"), (None, None, "x"), (5, c, "x"), (4, d, None), (9, e, "x"), (0, "other words", None)], key=str)


def test_links_of_planted_distances(spark):
    rng = random.Random(9)
    prints = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for distance in (1, 2, 3, 3, 4):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), distance)))
        prints.add(base ^ 7 << rng.randint(0, 61))  # three bits in one block
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    folder = scratch_dir(spark)
    table = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.linked(table, folder), folder).collect()}
    groups = collections.defaultdict(set)
    for p in prints:
        groups[roots.get(signed(p), signed(p))].add(p)
    want = collections.defaultdict(set)
    for p, root in classes_of(prints).items():
        want[root].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (7, 7), (101, 100)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"), scratch_dir(spark)).collect()
    assert sorted(map(tuple, found)) == [*((k, 0) for k in range(1, 61)), (101, 100)]


# shared helpers and the pipeline


def test_running_total(spark):
    table = spark.createDataFrame([(k, k % 7) for k in range(500)], "k long, v long").repartition(6)
    found = common.running_total(table, [F.col("k")], "v", scratch_dir(spark)).collect()
    assert {r.k: r["_before"] for r in found} == {k: sum(j % 7 for j in range(k)) for k in range(500)}


def test_pipeline_runs_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, seen = scratch_dir(spark), [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = store(stage(spark, docs, sf_dir), folder, str(k))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
        docs = result
        seen.append(docs.count())
    assert seen[0] > seen[1] >= seen[2] > seen[3] and seen[4] == seen[5] > 0
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


def test_stages_take_empty_and_odd_documents(spark, docs, empty, sf_dir):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for table in (empty, docs):
        current = table.select(*plain, F.lit("x").alias("size"))
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            current = store(stage(spark, current, sf_dir), scratch_dir(spark), str(k))
        assert current.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]


# null and shared identifiers


@pytest.fixture(scope="module")
def nameless(spark):
    texts = [prose(50), prose(50), prose(51), None, ""]
    data = [(None, t, "en", None, 1, "clash", 7, True, "r") for t in texts] + [(5, prose(52), None, "s", 1, "clash", 7, True, "r")] * 2
    return spark.createDataFrame(data, DOCS)


def test_rows_without_doc_id_keep_their_place(spark, nameless):
    labels = spark.createDataFrame([(5, 1), (None, 0)], "doc_id long, good int")
    mixed = mixing.mix(nameless, scratch_dir(spark), ["doc_id", "size"]).collect()
    assert len(mixed) == 7 and sorted(r.size for r in mixed) == [0, 0, 120, 120, 120, 120, 120] and {r._row.size for r in mixed} == {7}
    judged = quality.classify(nameless, labels, scratch_dir(spark), keep=["doc_id"]).collect()
    assert len(judged) == 7 and sum(r._row.doc_id is None for r in judged) == 5
    coded = bpe.encode_documents(nameless).collect()
    assert sorted(len(r.ids) == 0 for r in coded if r.doc_id is None) == [False] * 3 + [True] * 2
    ruled = rules.judge(nameless, labels.select("doc_id"), scratch_dir(spark)).collect()
    assert len(ruled) == 7 and {r._row.kept for r in ruled} == {True}
    assert sorted((r.n_words, r.base_failed) for r in ruled) == [(0, True)] * 2 + [(120, False)] * 5
    groups = simhash.near_duplicates(nameless, scratch_dir(spark)).collect()
    assert len(groups) == 7 and {r.component_id for r in groups if r.doc_id == 5} == {5}
    assert len({r.fp for r in groups}) == 4 and len(simhash.one_of_each(nameless, scratch_dir(spark)).collect()) == 4


def test_pages_that_share_a_name(spark):
    pages = spark.createDataFrame([(1, "u", "a"), (1, "v", "b"), (None, "w", "c"), (None, None, None)], "page_id long, url string, html string")
    folder = scratch_dir(spark)
    index = store(warc.write_archives(pages, f"{folder}/a"), folder, "index")
    named = warc.fetch(index, index.where("record_id like '%:1>'").select("record_id")).collect()
    assert sorted(bytes(r.payload) for r in named) == [b"a", b"b"]
    assert sorted(r.payload_bytes for r in warc.read_archives(warc.frames_of(index)).collect()) == [0, 1, 1, 1]


def test_no_pages_no_verdicts(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    outcomes = spark.createDataFrame([(1, 1), (None, 0)], "page_id long, bad int")
    assert urls.judge(none, outcomes, scratch_dir(spark)).count() == 0
    some = spark.createDataFrame([(None, "http://a.b/"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in urls.judge(some, outcomes.limit(0), scratch_dir(spark)).collect()] == ["allow", "allow"]
