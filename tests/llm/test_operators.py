"""Each operator against a plain version of its meaning, on awkward rows: nulls, empty and long texts, ties, repeats, further columns."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import contamination, order_minhash, packing, quality, queries, repair, repeats, simhash, templates, toxicity, wrappers

random.seed(7)
WORDS = ["the", "of", "and", "idiot", "Éclair", "naïve", "x1", "a,b", "###", "日本", "foo", "bar", "baz", "qux"]


def sentence(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


LONG = "\n".join(sentence(9) for _ in range(2500))
ROWS = [
    (1, sentence(40)), (2, None), (3, ""), (4, "   \n\n "), (5, LONG), (6, LONG), (7, "one"), (7, "one"), (8, "A b\x1cc 'S don't <|endoftext|>"),
    (None, sentence(12)), (9, "a " * 300), (10, "a" * 700), (11, LONG[:3000] + sentence(5)), (12, "ÀÉ ß. Ω, ﬁ é"),
    *[(20 + i, sentence(random.randrange(1, 60))) for i in range(40)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", 5, "x", 1) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, at int").repartition(5)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_packing(docs, none, tokenizer):
    pieces = packing.pack(docs, queries.tokenizer_path(), window=64, open_windows=4, slack=2).collect()
    windows = defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        windows[p.sequence_id].append(p)
    fills = []
    for own in windows.values():
        offset = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == offset
            offset += p.length
        fills.append(offset)
        assert offset <= 64
    assert sum(fills) >= 0.97 * 64 * len(fills)
    got, want = defaultdict(int), Counter((i, len(ids_of(tokenizer, t))) for i, t in ROWS)
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
    assert got == {k: k[1] * n for k, n in want.items()}
    five = sorted((p for p in pieces if p.doc_id == 5), key=lambda p: p.start)
    assert np.frombuffer(b"".join(p.ids for p in five), "<u4").tolist() == ids_of(tokenizer, LONG)
    assert packing.pack(none, queries.tokenizer_path()).count() == 0


def test_token_shards(spark, docs, none, tokenizer, tmp_path):
    path = str(tmp_path / "shards")
    repair.write_tokens(docs, path, queries.tokenizer_path(), shard_tokens=500)
    rows = repair.read_tokens(spark, path).collect()
    start = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == start
        start += row.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    got = by_id((r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)
    assert got == by_id((i, ids_of(tokenizer, t)) for i, t in ROWS)
    for shard in spark.read.parquet(path).collect():
        ends = np.frombuffer(shard["token_ends"], "<u4")
        whole = {i: repair.decode(shard.asDict(), i) for i in range(len(ends))}
        for i, ids in whole.items():
            assert (repair.decode(shard.asDict(), i, 2, 9) == ids[2:9]).all()
            assert len(repair.decode(shard.asDict(), i, 4, 4)) == 0
    empty = str(tmp_path / "empty")
    repair.write_tokens(none, empty, queries.tokenizer_path())
    assert repair.read_tokens(spark, empty).count() == 0


def test_grammar_saves_repeats():
    ids = np.tile(np.array([5, 6, 7, 5, 6, 8], np.uint32), 4000)
    symbols, ends, rules, expansions = repair.compress(ids, np.array([12000, 24000]), 49408)
    assert len(symbols) < len(ids) / 6
    assert (repair.expand(symbols, rules, 49408) == ids).all()
    assert repair.expand(symbols[: ends[0]], rules, 49408).size == 12000


def test_grammars_go_on_until_no_pair_is_frequent():
    """Copies of a document become one symbol, and no pair is left that occurs ``LEAST`` times, not even behind another of its bucket."""
    rng = np.random.default_rng(4)
    text = rng.integers(3, 9000, 999)
    ids, ends = np.tile(np.r_[text, 2], 260).astype(np.uint32), np.arange(1, 261) * 1000
    symbols, symbol_ends, rules, expansions = repair.compress(ids, ends, 49408)
    assert len(symbols) == 260 and expansions.max() == 1000
    assert (repair.expand(symbols, rules, 49408) == ids).all()
    many = rng.zipf(1.3, 60_000).clip(3, 49_000).astype(np.uint32)
    many[999::1000] = 2
    symbols, symbol_ends, rules, _ = repair.compress(many, np.arange(1, 61) * 1000, 49408)
    pairs = Counter()
    start = 0
    for end in symbol_ends:
        own = symbols[start:end].tolist()
        pairs.update(zip(own, own[1:]))
        start = end
    assert max(pairs.values()) < repair.LEAST
    assert (repair.expand(symbols, rules, 49408) == many).all()


def brute_classes(rows, radius):
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    ids = [i for i, _ in rows]
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return by_id((i, least.get(find(k))) for k, i in enumerate(ids))


def plain_simhash(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    import xxhash

    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_are_as_defined():
    for _, text in ROWS:
        assert simhash.fingerprint(text or "") == plain_simhash(text or "")


@pytest.mark.parametrize("hot", [64, 1])
@pytest.mark.parametrize("radius", [1, 2])
def test_simhash_classes(spark, docs, none, hot, radius):
    near = [(1000 + i, " ".join(w for j, w in enumerate(LONG[:2000].split()) if j != 7 * i)) for i in range(40)]
    more = spark.createDataFrame([(i, t, "", "", 0, "", 0) for i, t in near], docs.schema)
    got = simhash.near_duplicates(docs.unionAll(more), radius, hot).collect()
    assert by_id((r.doc_id, r.component_id) for r in got) == brute_classes(ROWS + near, radius)
    if hot == 1:
        assert simhash.near_duplicates(none).count() == 0


def test_near_duplicate_stage_keeps_one_of_each_class(spark, docs):
    """The stage is the SimHash operator: of each class of its links the least id stays, and null ids that lead none go."""
    import corpus_pipeline

    some = docs.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.one_of_each_group(spark, some, "")
    leads = {i for i, c in brute_classes(ROWS, 2) if i == c}
    assert {r.doc_id for r in kept.collect()} == leads
    assert corpus_pipeline.one_of_each_group(spark, some.limit(0), "").count() == 0


def test_thresholds_take_the_cheapest_sum():
    costs = [{-1: 0.0, 0: 5.0, 1: 9.0}, {-1: 0.0, 0: 50.0, 1: 90.0}, {-1: 0.0, 0: 6.0, 1: 30.0}]
    assert simhash.thresholds(costs, 0) == (15.0, (1, -1, 0))


def brute_repeats(rows, length):
    raws = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(r[k : k + length] for _, r in raws for k in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if counts[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone) if not g)))
    return by_id(out)


@pytest.mark.parametrize("samples, spans", [(500_000, 10_000), (500_000, 2), (3, 2)])
def test_repeats(docs, none, samples, spans):
    got = repeats.remove_repeats(docs, 60, 12, samples, spans).collect()
    assert by_id((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == brute_repeats(ROWS, 60)
    assert repeats.remove_repeats(none).count() == 0


def test_repeats_across_blocks(docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 500)
    got = repeats.remove_repeats(docs, 60, 12).collect()
    assert by_id((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == brute_repeats(ROWS, 60)


def test_order_minhash(spark, docs, none):
    rows = order_minhash.order_fingerprints(docs).collect()
    assert len(rows) == len(ROWS)
    texts = sorted(((i, t or "") for i, t in ROWS if i is not None), key=lambda r: (-r[0], r[1])) + [(i, t) for i, t in ROWS if i is None]
    want = []
    for (i, t), (_, n) in zip(texts, texts[1:] + texts[:1]):
        half = len(t) // 2
        want.append((i, len(t), t[: len(t) - half] + n[:half]))
    assert by_id((r.doc_id, r.n_chars, r.edited_text) for r in rows) == by_id(want)
    prints = {}
    for r in rows:
        text = {i: t or "" for i, t in ROWS}[r.doc_id]
        assert prints.setdefault(text, r.print) == r.print
    assert order_minhash.order_fingerprints(none).count() == 0


def plain_order_minhash(text, hashed):
    """Bins with their two least occurrence-numbered k-mers, put back into text order."""
    words = text.split()
    kmers = [tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    seen, bins = Counter(), defaultdict(list)
    for at, k in enumerate(kmers):
        h = hashed[k, seen[k]]
        bins[h >> 58].append((h, at, k))
        seen[k] += 1
    return {b: tuple(k for _, _, k in sorted(sorted(own)[:2], key=lambda x: x[1])) for b, own in bins.items()}


def test_order_minhash_agrees_where_a_plain_one_does(spark):
    base = [f"w{random.randrange(30)}" for _ in range(400)]
    swapped = base[200:] + base[:200]
    texts = [" ".join(base), " ".join(base[:390]), " ".join(swapped), " ".join(random.sample(base, 400)), "a b " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    prints = [r.print for r in order_minhash.with_fingerprint(df, "text", "print").orderBy("doc_id").collect()]
    kmers = {(k, n) for t in texts for k, n in (
        (k, n) for w in [t.split()] for k, c in Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)).items() for n in range(c))}
    rows = spark.createDataFrame([(list(k), n) for k, n in kmers], "k array<string>, n int")
    h = rows.selectExpr("k", "n", "xxhash64(xxhash64(xxhash64(k[0]), xxhash64(k[1]), xxhash64(k[2])), n) as h").collect()
    hashed = {(tuple(r.k), r.n): r.h & (2**64 - 1) for r in h}
    plain = [plain_order_minhash(t, hashed) for t in texts]
    for own, want in zip(prints, plain):
        assert sorted(v >> 16 for v in own) == sorted(want)
    for i in range(len(texts)):
        for j in range(i):
            same = sum(plain[i].get(b) == plain[j].get(b) for b in plain[i].keys() & plain[j].keys())
            assert len(set(prints[i]) & set(prints[j])) == same


def test_contamination(spark, none):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    cut = " ".join(item.split()[:18])
    docs = [(1, sentence(500) + " " + item.upper() + " " + sentence(300)), (2, cut), (3, " ".join(item.split()[:16])), (4, None), (5, ""), (6, "a b"), (None, item)]
    items = [(1, item), (2, "a b"), (3, None), (4, ""), (None, cut)]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, h int, s int")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {(1, 1), (2, 1), (None, 1), (6, 2), (1, None), (2, None), (3, None), (None, None)}
    for most in (500_000, 0):
        got = contamination.contained_items(d, b, broadcast_rows=most).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert contamination.contained_items(d.withColumn("suspect", F.lit(1)).withColumn("k", F.lit(1)), b).count() == len(want)
    assert contamination.contained_items(d.limit(0), b).count() == 0
    assert contamination.contained_items(d, b.limit(0)).count() == 0


def test_short_items_are_found_in_longer_documents(spark):
    docs = [(1, "x y Red fox\nran z"), (2, "red  fox ran"), (3, "red fox"), (4, "fox"), (5, "foxes ran red")]
    items = [(1, "red fox ran"), (2, "fox"), (3, "red fox"), (4, "ran far away")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = contamination.contained_items(d, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in got) == [
        (1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (2, 1, 1, 1), (2, 2, 1, 1), (2, 3, 1, 1), (3, 2, 1, 1), (3, 3, 1, 1), (4, 2, 1, 1),
    ]


def test_a_phrase_that_all_share_makes_no_candidates(spark, monkeypatch):
    """Items and documents that have one phrase in common, and no match but one."""
    sizes = {}
    real = contamination.stored

    def counted(df, name):
        found = real(df, name)
        sizes[name] = found.count()
        return found

    monkeypatch.setattr(contamination, "stored", counted)
    phrase = "all of them have this one phrase"
    items = [(i, f"{phrase} " + " ".join(f"i{i}w{j}" for j in range(15))) for i in range(60)]
    docs = [(i, " ".join(f"d{i}w{j}" for j in range(10)) + f" {phrase}") for i in range(300)] + [(300, "so " + items[7][1])]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contamination.contained_items(d, b).collect()] == [(300, 7)]
    assert sizes["candidates"] == 1


def test_templates(spark, none):
    lines = ["Page %d of 12 in this book", "visit our site for more news %s"]
    rows = [(i, "\n".join(["own words of number %d here %s" % (i, sentence(8)), lines[0] % i, "  visit our site\tfor more news today ", "The."])) for i in range(6)]
    rows += [(6, None), (7, ""), (3, "other text of the same id\nPage 9 of 12 in this book"), (None, "Page 7 of 3 in this book")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, leaf int, n_lines int")
    for most in (500_000, 0):
        got = templates.drop_recurring_lines(d, broadcast_rows=most).collect()
        kept = {(r.doc_id, r.text) for r in got}
        assert (0, rows[0][1]) in kept and (6, "") in kept and (7, "") in kept and (None, "") in kept
        assert (1, rows[1][1].split("\n")[0]) in kept
        assert (3, "other text of the same id") in kept
        assert len(got) == len(rows)
    assert templates.drop_recurring_lines(d.limit(0)).count() == 0
    clashing = d.withColumns({c: F.lit(1) for c in ("places", "of", "row", "at", "n", "line", "__places")})
    assert {(r.doc_id, r.text) for r in templates.drop_recurring_lines(clashing).collect()} == kept


def staged_lines(spark, texts):
    import corpus_pipeline

    some = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    return {r.doc_id: r.text for r in corpus_pipeline.without_template_lines(spark, some, "").collect()}


def test_pipeline_drops_short_recurring_lines(spark):
    texts = [f"opening {i}\n\n All rights\treserved.\n{i}\nnote {i}" for i in range(4)] + ["Only twice\nlast a"] + ["Only twice\nlast b"]
    got = staged_lines(spark, texts)
    assert got[0] == texts[0] and got[4] == texts[4] and got[5] == texts[5]
    assert all(got[i] == f"opening {i}\n\n{i}\nnote {i}" for i in (1, 2, 3))


def test_pipeline_drops_long_lines_of_two_documents(spark):
    passage = " ".join(f"p{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60))
    cut = " ".join(passage.split()[1:20])
    got = staged_lines(spark, [f"own one\n{passage}\n{cut}", f"own two\n{cut}\n  {passage} ", "own three"])
    assert got == {0: f"own one\n{passage}\n{cut}", 1: f"own two\n{cut}", 2: "own three"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "</p>";</script></head><body><header>Site</header>
<nav><ul><li><a href="/a">A</a></li><li>B</li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="layout"><div class="sidebar">Side</div><div class="content-body"><h1>Head %d</h1><p>First  &amp; %s</p><h6>Share this page</h6>
<ul><li>one<li>two</ul><form><input>Send</form><div class="advert">Buy</div></div></div>
<section id="comments"><p>%s %s %s</p></section><footer>Foot</footer></body></html>"""


def test_main_text(spark):
    bodies = [sentence(30) for _ in range(8)]
    pages = [(i, f"http://h.example/{i}", PAGE % (i, b, b, b, b), 0) for i, b in enumerate(bodies)]
    pages += [(50, None, None, 0), (51, "odd", "", 0), (52, "http://h.example/x", "<p>cut &am", 0), (53, "http://one.example", "<article><p>Whole<br>text</p><p>two<div cla", 0), (53, "http://one.example", "plain", 0)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    for most in (wrappers.BROADCAST_BYTES, 0):
        got = sorted((r.page_id, r.text) for r in wrappers.main_texts(df, most).collect())
        want = [(i, f"Head {i}\n\nFirst & {' '.join(b.split())}\n\none\n\ntwo") for i, b in enumerate(bodies)]
        assert got == sorted(want + [(50, ""), (51, ""), (52, "cut &am"), (53, "Whole text\n\ntwo"), (53, "plain")])
    assert wrappers.main_texts(df.limit(0)).count() == 0


def test_main_text_of_deep_pages(spark):
    deep = {"div": "<div>" * 5000 + "deep text" + "</div>" * 5000, "span": "<p>" + "<span>" * 5000 + "deep text", "font": "<font>" * 5000 + "deep text"}
    pages = [(10 * k + i, f"http://{name}.example/{i}", html) for k, (name, html) in enumerate(deep.items()) for i in range(2)]
    pages.append((99, "http://plain.example", "<article><p>plain</p></article>"))
    got = wrappers.main_texts(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {i: "plain" if i == 99 else "deep text" for i, _, _ in pages}


def test_wrapper_is_union_free():
    one = wrappers.wrapper(wrappers.parse("<div><p>a</p><p>b</p><i>x</i></div>"))
    two = wrappers.wrapper(wrappers.parse("<div><p>a</p><b>y</b></div>"))
    div = wrappers.align(one, two)[wrappers.INSIDE][0]
    said = [(x[wrappers.SIG], x[wrappers.OPTIONAL], x[wrappers.REPEATED]) for x in div[wrappers.INSIDE]]
    assert said == [("p", False, True), ("i", True, False), ("b", True, False)] or said == [("p", False, True), ("b", True, False), ("i", True, False)]


def held_out(spark, name, by, part, score, sf="sf0.1"):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").repartition(8)
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    learnt = labels.filter(quality.remainder(labels.doc_id, by) != part).selectExpr("doc_id", f"{name} as y")
    scores = {r.doc_id: r.score for r in score(docs, learnt).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    kept = [(r[name], scores[r.doc_id]) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % by == part]
    return np.array([y for y, _ in kept]), np.array([s for _, s in kept])


def test_quality_on_held_out_rows(spark):
    y, s = held_out(spark, "quality", 4, 2, quality.score_quality)
    assert ((s >= quality.THRESHOLD) == y).mean() > 0.97


def test_toxicity_on_held_out_rows(spark):
    y, s = held_out(spark, "toxic", 5, 0, toxicity.score_toxicity)
    assert ((s >= toxicity.THRESHOLD) == y).mean() > 0.96
    assert (s[y == 0] >= toxicity.THRESHOLD).mean() < 0.02


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_on_awkward_rows(spark, docs, none, score):
    labels = spark.createDataFrame([(1, 1), (5, 0), (5, None), (999, 1), (None, 1)], "doc_id long, y int")
    for known in (labels, labels.limit(0), labels.filter("y = 1")):
        assert score(docs, known).count() == len(ROWS)
    assert score(none, labels).count() == 0


def test_isotonic_is_the_nearest_monotone_fit():
    assert quality.isotonic(np.array([1.0, 0, 2, 1]), np.array([1.0, 1, 2, 2])).tolist() == [0.5, 0.5, 0.75, 0.75]


def test_trigrams_of_blocks_add_up(monkeypatch):
    some = [t or "" for _, t in ROWS]
    whole = toxicity.trigram_counts(some)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert whole.sum() == sum(map(len, some)) + 2 * len(some)
    assert (toxicity.trigram_counts(some) == whole).all() and (sum(toxicity.trigram_counts([t]) for t in some) == whole).all()
    assert not toxicity.trigram_counts([]).any()


def test_disguised_words_are_restored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    restorer = toxicity.corpus_restorer(docs)
    for word, plain in [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooot!!", "idiot"), ("tr@sh", "trash"), ("Plain,", "plain"), ("l0$er", "loser")]:
        assert restorer.word(word) == plain
    assert restorer.restore("so p a t h e t i c, no?").split() == ["so", "pathetic", "no"]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name, scale):
    df = queries.QUERIES[name](spark, f"/root/testdata/{scale}")
    db = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS FROM '/root/testdata/{scale}/{t}.parquet'")
    columns = sorted(df.columns)
    expected = db.sql(queries.ORACLE_SQL[name])
    assert columns == sorted(expected.columns)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(expected.select(*columns).fetchall())


def test_digest_queries(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole = {i: np.array(ids_of(tokenizer, t), "<u4").tobytes() for i, t in texts.items()}
    start = 0
    shards = {r.doc_id: r for r in queries.op7_token_shards(spark, sf).collect()}
    for i in sorted(texts):
        assert (shards[i].start, shards[i].n_tokens, shards[i].ids_crc32) == (start, len(whole[i]) // 4, zlib.crc32(whole[i]))
        start += len(whole[i]) // 4
    for p in queries.op2_packing(spark, sf).collect():
        assert p.ids_crc32 == zlib.crc32(whole[p.doc_id][4 * p.start : 4 * (p.start + p.length)])
    kept = {i: (n, g, s, hashlib.sha256(k).hexdigest()) for i, n, g, s, k in brute_repeats(list(texts.items()), 200)}
    for r in queries.op10_repeats(spark, sf).collect():
        assert kept[r.doc_id] == (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
    for r in queries.op8_simhash(spark, sf).collect():
        assert r.fingerprint == f"{plain_simhash(texts[r.doc_id]):016x}"


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], sf))
        assert kept[-1].columns == docs.columns
        assert kept[-1].dtypes == docs.dtypes
    rows = [{r.doc_id: r.text for r in k.collect()} for k in kept]
    scores = {r.doc_id: r.predicted for r in queries.op3_quality(spark, sf).collect()}
    assert rows[1] == {i: t for i, t in rows[0].items() if scores[i]}
    classes = dict(brute_classes(list(rows[2].items()), 2))
    assert set(rows[3]) == {i for i in rows[2] if classes[i] == i}
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {p.doc_id for p in packed} == set(rows[4])


def test_marks_at_words_that_come_again(monkeypatch):
    """A known word with marks is parted once, and ids are the tokenizer's own."""
    from tokenizers import Tokenizer

    from landfall.llm import tokens

    whole = Tokenizer.from_file(queries.tokenizer_path())
    words = tokens.WordTokenizer(queries.tokenizer_path())
    text = "alpha, bêta. gamma... alpha),\ngamma"
    words.encode("alpha bêta gamma")
    words.encode(text)
    asked = []
    learnt = words._learnt
    monkeypatch.setattr(words, "_learnt", lambda word: asked.append(word) or learnt(word))
    assert list(np.frombuffer(words.encode(text), "<u4")) == whole.encode(text, add_special_tokens=False).ids
    assert asked == []
    odd = [
        "don't, can't. 's,t", "a.b,c", "a'.b", "x≠y", "é́, é.", "ſ.ſ", "a,'s", "a\t,b", "A-b_c", "555-a,5", "ß~·", "a.,;b", "İ, İ.b", "a, <|endoftext|>b, <|EndOfText|>", "Œ'll!",
    ]
    for text in odd:
        assert list(np.frombuffer(words.encode(text), "<u4")) == whole.encode(text, add_special_tokens=False).ids, text
