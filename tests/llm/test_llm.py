"""The text operators against brute-force versions, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from depotflow.llm import langid, language_model, latent, linking, mixing, ordinal, simhash, sitetree, spotsigs, substrings, subwords
from depotflow.llm.common import LOWER, held_out
from depotflow.llm.queries import llm_oracles, llm_queries

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, node int, starts int, bucket int, kind int, __x int"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))
SMALL = "/root/testdata/sf0.001"


def some_texts(count: int = 120, seed: int = 3) -> list[str]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "and", "la", "de"]
    texts = []
    for i in range(count):
        text = [rng.choice(words) for _ in range(rng.randint(0, 90))]
        if texts and rng.random() < 0.5:  # copies, near copies and shared passages
            other = rng.choice(texts).split()
            text = other if rng.random() < 0.3 else other[: rng.randint(0, len(other))] + text[: rng.randint(0, 10)]
        texts.append(" ".join(text))
    return texts


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", 1, 2, 3, 4, 5) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(some_texts()))
    return rows, frame(spark, rows).repartition(5).persist()


AWKWARD = [
    (None, "a text without id, the one and only"), (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "the same of it"),
    (5, "the same of it"), (6, "the same of it"), (7, "x"), (8, "Ünïcode 日本語 текст"), (9, "%%% !!! ###"), (-3, "nul\x00byte"),
]


def lists(out):
    return sorted(([tuple(r) for r in out.collect()]), key=str)


def words(text):
    return (text or "").encode().split()


# --- brute force --------------------------------------------------------------------------------


def test_simhash_components(texts):
    rows, docs = texts

    def fingerprint(text):
        tokens = words(text)
        tokens = [w.translate(LOWER) for w in tokens]
        runs = [b" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] or ([b" ".join(tokens)] if tokens else [])
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {i: fingerprint(t) for i, t in rows}
    least = {i: i for i in prints}
    for _ in rows:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a] = min(least[a], least[b])
    want = sorted(((i, f"{prints[i]:016x}", least[i]) for i in prints), key=str)
    assert lists(simhash.simhash_components(docs)) == want


def test_blocks_of_large_buckets_connect_the_same(spark):
    rng = random.Random(1)
    nodes = sorted({(rng.getrandbits(4) << 20) ^ (1 << rng.randrange(12)) ^ (1 << rng.randrange(12)) for _ in range(150)})
    rows = spark.createDataFrame([(0, n, None) for n in nodes], "bucket bigint, node bigint, sig binary")
    near = simhash._hamming_near(3)
    split = linking.components(linking.bucket_links(rows, near, block=16))
    whole = linking.components(linking.bucket_links(rows, near))
    assert lists(split.distinct()) == lists(whole.distinct())


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_substrings(spark, texts, batch):
    rows, docs = texts
    places = Counter(tuple(words(t)[i : i + 9]) for _, t in rows for i in range(len(words(t)) - 8))
    want = []
    for i, t in rows:
        w = words(t)
        gone = {j + k for j in range(len(w) - 8) if places[tuple(w[j : j + 9])] > 1 for k in range(9)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        want.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert lists(substrings.substring_digests(docs, 9)) == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_full_sketch_changes_nothing(texts):
    _, docs = texts
    tight = substrings.remove_repeats(docs, 9, width_bits=4).select("doc_id", "text", "__removed__")
    assert lists(tight) == lists(substrings.remove_repeats(docs, 9).select("doc_id", "text", "__removed__"))


def test_edited_fingerprints(spark, monkeypatch, texts):
    rows, docs = texts
    monkeypatch.setattr(spotsigs, "ROWS_PER_BUCKET", 10)
    ordered = sorted(rows, reverse=True)
    want = {}
    for place, (i, t) in enumerate(ordered):
        after = ordered[(place + 1) % len(ordered)][1]
        third = len(t) // 3
        want[i] = (len(t), hashlib.sha256((t[: len(t) - third] + after[:third]).encode()).hexdigest())
    got = spotsigs.edited_fingerprints(docs).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want and len(got) == len(rows)
    same = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert same.setdefault(dict(rows)[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]


def test_similar_spot_pairs(texts):
    _, docs = texts
    sets = {r["class"]: frozenset(r["spots"]) for r in spotsigs.fingerprint_classes(docs).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    got = {(r[0], r[1]) for r in spotsigs.similar_pairs(docs, 0.6).collect()}
    assert got == want


def test_language_model(monkeypatch, texts):
    rows, docs = texts
    monkeypatch.setattr(language_model, "BLOCK_CHARS", 900)
    tokens = {i: [*words(t), b"END"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, distinct = sum(counts.values()), len(counts)
    got = language_model.language_model_scores(docs, held_out(10, 0)).collect()
    assert len(got) == len(rows)
    for r in got:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(own), sum(counts[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_planes_round_trip():
    c1, c2 = np.array([5, 70000, 1]), np.array([2, 0, 1])
    a, b, context = language_model._unplanes(language_model._planes(c2, np.array([9, 5, 70000]), c1))
    assert (a.tolist(), b.tolist(), context.tolist()) == (c1.tolist(), c2.tolist(), [9, 5, 70000])
    numbers = np.array([1, 2**40, 7], np.uint64)
    assert language_model._unpack(language_model._pack(numbers), np.uint64).tolist() == numbers.tolist()


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    scores, owner = rng.normal(0, 5, (11, 3)).astype(np.float32), np.array([0] * 6 + [2] * 5)
    path = langid._viterbi(scores, owner, 3, 4.0)

    def value(part, route):
        return sum(part[t, s] for t, s in enumerate(route)) - 4.0 * sum(a != b for a, b in zip(route, route[1:], strict=False))

    for text, size in ((0, 6), (2, 5)):
        part = scores[owner == text]
        best = max(value(part, [n // 3**t % 3 for t in range(size)]) for n in range(3**size))
        assert value(part, path[owner == text].tolist()) == pytest.approx(best, abs=1e-3)


def test_language_spans(spark):
    english = "the of and that with this from there would have been".split()
    german = "nicht auch der die das schön ungefähr zwischen während können".split()
    rows = [(i, " ".join(random.Random(i).choices(english if i % 2 else german, k=40)), "en" if i % 2 else "de") for i in range(40)]
    rows += [(100 + i, "привет мир это русский текст", "ru") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit_languages(docs)
    mixed = spark.createDataFrame([(1, " ".join(english) + ". " + " ".join(german) + " это мир"), (2, "123 !"), (3, None)], "doc_id bigint, text string")
    spans = lists(langid.language_spans(mixed, model))
    assert [(s[1], s[4]) for s in spans] == [(0, "en"), (1, "de"), (2, "ru")]
    shown = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.document_languages(mixed, model).collect()}
    assert shown[2] == shown[3] == ("und", 0.0) and 0.3 < shown[1][1] < 0.8


def test_subsequence():
    rng = random.Random(4)
    for _ in range(60):
        a, b = [rng.randrange(6) for _ in range(rng.randrange(1, 12))], [rng.randrange(6) for _ in range(rng.randrange(12))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent.common_subsequence(a, b) == table[-1][-1]


def test_leaks_verbatim_and_paraphrased(spark):
    rng = random.Random(9)
    names = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(3000)]
    items = [(k, " ".join(rng.sample(names, 20))) for k in range(12)]
    docs = [(i, " ".join(rng.choices(names, k=rng.randint(0, 400)))) for i in range(150)]
    want = set()
    for k, item in items:
        kept = [w for w in item.split() if rng.random() < 0.85 or k % 2]
        body = docs[k][1].split()
        docs[k] = (k, " ".join([*body[:50], *kept, *body[50:]]).upper())
        want.add((k, k))
    found = latent.benchmark_leaks(frame(spark, docs), spark.createDataFrame([*items, (99, None), (98, " ")], "item_id bigint, text string"))
    assert {(r[0], r[1]) for r in found.collect()} == want


def test_a_long_item_hides_no_short_ones(spark):
    """Planted items, verbatim and paraphrased, are all found beside an item of 4,000 words."""
    rng = random.Random(12)
    vocabulary = [f"v{i}" for i in range(3000)]
    pick = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: pick(rng.randint(15, 59)) for i in range(60)} | {60: pick(4000)}
    docs = []
    for at, item in items.items():
        said = [w for w in item if at % 3 or rng.random() > 0.1]  # every third is a paraphrase
        if at % 3 == 0:
            for _ in range(len(said) // 5):
                said.insert(rng.randrange(len(said)), "so")
        docs.append((at, " ".join([*pick(9000), *said, *pick(9000)])))
    docs += [(100 + i, " ".join(pick(2000))) for i in range(100)]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string")
    got = {(r[0], r[1]) for r in latent.benchmark_leaks(frame(spark, docs), table).collect()}
    assert {(i, i) for i in items} <= got


def test_similar_documents_stay_once(spark):
    rng = random.Random(2)
    base = [f"t{rng.randrange(10**6)}" for _ in range(400)]
    near, far = [*base], [*base[:200], *(f"u{i}" for i in range(200))]
    near[100] = "other"
    rows = [(3, " ".join(base)), (1, " ".join(near)), (2, " ".join(base)), (4, " ".join(far)), (4, " ".join(far)), (5, "lone")]
    kept = simhash.keep_first(frame(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5] and kept.columns == frame(spark, rows).columns


def test_similarity_is_exact_around_the_threshold(spark):
    """Chained and single pairs on both sides of 0.8 group as a full comparison of sets does."""
    rng = random.Random(8)
    rows: list[tuple[int, str]] = []
    for at in range(160):
        base = [f"p{rng.randrange(10**7)}" for _ in range(rng.randint(150, 500))]
        least = len(base) - 4
        for _ in range(rng.choice([1, 1, 2])):
            other, wanted = [*base], rng.uniform(0.74, 0.86)
            changed = round(least * (1 - wanted) / (1 + wanted))  # shingles that one side lacks
            other[-changed:] = [f"q{rng.randrange(10**7)}" for _ in range(changed)]
            rows.append((len(rows), " ".join(other)))
        rows.append((len(rows), " ".join(base)))
    sets = [frozenset(zip(*[t.split()[k:] for k in range(5)], strict=False)) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(max(0, i - 3), i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_components(frame(spark, rows)).collect()}
    assert got == dict(enumerate(root)) and 80 < len(set(root)) < len(rows) - 80


def test_pages():
    page = """<html><head><title>T</title></head><body><header>site</header><div class="cookie-notice">ok?</div><nav><a>menu</a></nav>
      <article><h1>Head &amp; line</h1><p>One<br>two <b>three<p>four&nbsp;five<script>var x="</p>";</script><div class="ad">buy</div>
      <section id="comments"><p>first!</p></section></article><aside>side</aside><footer>&copy;</footer></body></html>"""
    assert sitetree.main_text(page, frozenset()) == "Head & line\n\nOne two three\n\nfour five"
    assert sitetree.main_text(None, frozenset()) == sitetree.main_text("", frozenset()) == ""
    assert sitetree.main_text("a &lt; b < c", frozenset()) == "a < b < c"


@pytest.mark.parametrize(
    "page",
    [
        "<body class='content-sidebar'><article>%s</article></body>",
        "<html class=sidebar><body id=ad class='widget'><div>%s</div></body></html>",
        "<body><div id='wrap' class='has-sidebar'><p>%s</p></div></body>",
        "<body><div class='widget'><div class='comments'><main>%s<div class=ad>buy</div></main></div></div><div class=related>x</div></body>",
        "<body><article class='share-news'>%s</article><div class='comments'><article>me too, and much longer</article></div></body>",
        "<body><article class='share'>%s</article></body>",
        "<form id=f><div class=header><article>%s</article></div></form><div class='cookie-notice'>ok?</div>",
        "<body><nav>menu</nav><div class=widget>%s</div></body>",
    ],
)
def test_wrappers_are_not_noise_by_name(page):
    assert sitetree.main_text(page % "the story", frozenset()) == "the story"


def test_site_tree_drops_what_all_pages_show(spark):
    body = "<body><div id=top>welcome to the site</div><div id=text><p>story %d of many</p></div><div id=end>call us</div></body>"
    rows = [(i, f"http://h.org/{i}", body % i) for i in range(30)] + [(99, "http://one.org", body % 99), (98, None, None)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[7] == "story 7 of many" and got[98] == "" and got[99] == "welcome to the site\n\nstory 99 of many\n\ncall us"


def test_site_tree_judges_pages_with_articles(spark):
    page = "<body><div id=top>welcome</div><article><p>story %s</p><div id=plug>read our book</div></article><div id=card>more of %s</div></body>"
    shown = [(i, "http://big.org", page % (i, i)) for i in range(40)] + [(100 + i, "http://few.org", page % (i, i)) for i in range(3)]
    shown += [(200 + i, "http://copies.org", page % ("once", "once")) for i in range(40)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract_main_text(spark.createDataFrame(shown, "page_id bigint, url string, html string")).collect()}
    assert got[7] == "story 7\n\nmore of 7"  # the tree drops what all articles end with and keeps what differs beside them
    assert got[101] == "story 1\n\nread our book" and got[239] == "story once\n\nread our book"  # the prior holds


def labelled(spark, count=300):
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(count):
        tokens = [f"w{rng.randrange(400)}" for _ in range(60)]
        toxic, good = i % 5 == 0, i % 3 != 0
        tokens = ["badword" if toxic and rng.random() < 0.1 else t for t in tokens]
        docs.append((i, " ".join(tokens) if good else " ".join(t.upper() + "!!" for t in tokens)))
        labels.append((i, int(good), int(toxic)))
    return frame(spark, docs), spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (10**6, 0, 1)], "doc_id bigint, quality int, toxic int")


def test_classifiers_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    learned = labels.filter("doc_id % 4 <> 0")
    scored = ordinal.severities(docs, ordinal.fit_ordinal(docs, learned)).collect()
    assert np.mean([r["toxic"] == (r["doc_id"] % 5 == 0) for r in scored if r["doc_id"] % 4 == 0]) > 0.95
    assert all((r["severity"] >= 0) and (r["severity"] <= 3) for r in scored)
    quality = subwords.quality_scores(docs, subwords.fit_quality(docs, labels, ~held_out(3, 1))).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 3 != 0) for r in quality if r["held_out"]]) > 0.95


def test_rates_meet_targets(spark):
    docs, labels = labelled(spark)
    out = mixing.mixing_rates(docs, labels, {"good": 0.5, "low": 0.3, "toxic": 0.2}).toPandas()
    total = out["n_tokens"].sum()
    for name, share in (("good", 0.5), ("low", 0.3), ("toxic", 0.2)):
        assert (out["n_tokens"] * out["rate"] * out[f"p_{name}"]).sum() == pytest.approx(share * total, abs=0.01 * total)
    assert (out["rate"] >= 0).all() and len(out) == docs.count()


# --- awkward rows and empty tables ----------------------------------------------------------------


def operators(docs, labels, benchmark):
    none = frame(docs.sparkSession, [])
    return {
        "spots": lambda: spotsigs.edited_fingerprints(docs),
        "model": lambda: language_model.language_model_scores(docs, held_out(10, 0)),
        "language": lambda: langid.document_languages(docs, langid.fit_languages(docs)),
        "unlearned language": lambda: langid.document_languages(docs, langid.fit_languages(none)),
        "quality": lambda: subwords.quality_scores(docs, subwords.fit_quality(docs, labels)),
        "simhash": lambda: simhash.simhash_components(docs),
        "similar": lambda: simhash.similar_components(docs),
        "substrings": lambda: substrings.substring_digests(docs),
        "mixing": lambda: mixing.mixing_rates(docs, labels),
        "toxicity": lambda: ordinal.severities(docs, ordinal.fit_ordinal(docs, labels)),
    }


@pytest.mark.parametrize("labels", ["none", "some"])
def test_one_row_per_awkward_document(spark, labels):
    docs = frame(spark, AWKWARD)
    known = spark.createDataFrame([] if labels == "none" else [(4, 1, 0), (5, 0, 1), (8, 1, 0), (7, 0, 1)], "doc_id bigint, quality int, toxic int")
    for name, build in operators(docs, known, None).items():
        got = sorted(str(r["doc_id"]) for r in build().collect())
        assert got == sorted(str(i) for i, _ in AWKWARD), name


def test_empty_tables(spark):
    docs, labels = frame(spark, []), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for name, build in operators(docs, labels, None).items():
        assert build().collect() == [], name
    benchmark = spark.createDataFrame([(1, "some item of the benchmark")], "item_id bigint, text string")
    assert latent.benchmark_leaks(docs, benchmark).collect() == []
    assert latent.benchmark_leaks(frame(spark, AWKWARD), benchmark.limit(0)).collect() == []
    assert sitetree.extract_main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def test_pipeline_stages_on_awkward_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(4, 1, 0), (5, 0, 1), (8, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "Ünïcode 日本語 текст"), (3, "")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in (AWKWARD, []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns and out.count() <= len(rows), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)


def test_pipeline_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()}
    assert 0.5 * docs.count() < len(kept) < docs.count()


def test_queries_cover_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in llm_queries()) == list(range(1, 14))
    assert set(llm_oracles()) <= set(llm_queries())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_queries_against_sql(spark, name):
    import duckdb

    from compare import differences

    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    assert differences(llm_queries()[name](spark, SMALL), connection, llm_oracles()[name]) == []
