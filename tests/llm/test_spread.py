"""Hot nodes and hosts, rows that share an id, fits that cannot be met, and importance by brute force."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from depotflow.llm import linking, mixing, simhash, sitetree
from depotflow.llm.common import free_name


def joined_components(links):
    root: dict[int, int] = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {node: find(node) for node in root}


@pytest.mark.parametrize("cold", [0, 3, 10_000])
def test_components_with_hot_nodes(spark, monkeypatch, cold):
    rng = random.Random(6)
    links = [(7, 1000 + i) for i in range(300)] + [(2000 + i, 5) for i in range(100)] + [(2000, 1299), (9, 9)]
    links += [(3000 + i, 3001 + i) for i in range(40)]
    links += [(4000 + rng.randrange(80), 4000 + rng.randrange(80)) for _ in range(70)] + [(7, 1000), (1000, 7)]
    monkeypatch.setattr(linking, "COLD_LINKS", cold)
    got = linking.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(4)).collect()
    want = joined_components([(a, b) for a, b in links if a != b])
    assert {r["node"]: r["root"] for r in got} == want and len(got) == len(want)


def test_broadcast_of_hot_nodes_is_bounded(spark, monkeypatch):
    links = spark.range(1000).select((F.col("id") % 50).alias("u"), F.col("id").alias("v"))
    for cold in (5, 19, 20):
        rows = linking._with_least(links, cold).collect()
        assert sorted((r["u"], r["v"], r["m"]) for r in rows) == sorted((i % 50, i, i % 50) for i in range(1000))


def some_text(rng, size=300):
    return [f"t{rng.randrange(10**6)}" for _ in range(size)]


def test_rows_that_share_an_id_are_judged_by_their_texts(spark):
    rng = random.Random(3)
    first, second, third = some_text(rng), some_text(rng), some_text(rng)
    near, near_third = [*first], [*third]
    near[150], near_third[20] = "other", "other"
    rows = [
        (1, " ".join(first)), (1, " ".join(second)), (1, " ".join(second)), (2, " ".join(near)), (2, " ".join(some_text(rng))),
        (3, " ".join(third)), (3, " ".join(near_third)), (None, " ".join(first)), (None, None), (4, None), (4, ""), (5, "  "),
    ]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, __text_key__ int, __alone__ int")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    thirds = [(3, " ".join(third)), (3, " ".join(near_third))]
    blanks = [(4, None), (4, "")]
    assert sum(got[t] for t in thirds) == 1 and sum(got[t] for t in blanks) == 1
    rest = {k: n for k, n in got.items() if k not in thirds and k not in blanks}
    assert rest == {rows[0]: 1, rows[1]: 1, rows[4]: 1, (None, rows[0][1]): 1, (None, None): 1}
    assert free_name(docs, "__ALONE__") == "__ALONE___"


def chances(spark, alpha, count=400):
    values = np.random.default_rng(4).dirichlet(alpha, count)
    rows = [(i, 1 + i % 90, [float(x) for x in p]) for i, p in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint, chances array<double>"), np.array([r[1] for r in rows]), values


def test_rates_where_domains_are_hardly_told_apart(spark):
    frame, tokens, values = chances(spark, [30, 30, 30])
    domains, targets = ["a", "b", "c"], {"a": 0.36, "b": 0.34, "c": 0.30}
    steps, report = mixing.fit_steps(frame, domains, targets)
    rows = mixing.fit_rates(frame, domains, targets).orderBy("doc_id").collect()
    rates = np.array([r["rate"] for r in rows])
    reached = (tokens * rates) @ values
    wanted = np.array([0.36, 0.34, 0.30]) * tokens.sum()
    assert (np.abs(reached - wanted) <= 1e-3 * wanted).all() and (rates >= 0).all() and (rates == 0).any()
    assert all(r["met"] for r in report) and rows[0]["unmet"] == [] and len(steps) <= 15
    assert np.allclose([r["expected"] for r in report], reached)


def test_targets_out_of_reach_are_reported(spark):
    frame, tokens, values = chances(spark, [5, 5, 1e-9])
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    _, report = mixing.fit_steps(frame, ["a", "b", "c"], targets)
    assert [r["met"] for r in report][2] is False
    assert mixing.fit_rates(frame, ["a", "b", "c"], targets).first()["unmet"][-1] == "c"
    _, report = mixing.fit_steps(frame.filter("false"), ["a"], {"a": 1.0})
    assert report == [{"domain": "a", "tokens": 0.0, "expected": 0.0, "target": 0.0, "met": True}]


PAGE = "<body><div id=top>welcome</div>{}<article><p>{}</p><div class=plug>{}</div></article><ul><li>{}</li><li>more</li></ul></body>"


def site(spark):
    rng = random.Random(9)
    pages = [(i, f"http://{rng.choice('abb')}.org/{i}", PAGE.format("<hr><p>x</p>" * (i % 3), f"story {i}", f"buy {i % 4}", f"see {i % 7}")) for i in range(60)]
    pages += [(70 + i, "http://b.org/", pages[0][2].replace("see 0", "see 5")) for i in range(5)] + [(90, None, "<p>alone</p>"), (91, None, None)]
    return spark.createDataFrame(pages, "page_id bigint, url string, html string"), pages


def test_node_importance_by_brute_force(spark):
    frame, pages = site(spark)
    rows = frame.withColumn("host", sitetree.host_of(F.col("url")))
    got = {(r["host"], r["node"]): (r["main"], r["pages"], r["importance"]) for r in sitetree.node_importance(rows).collect()}
    hosts = defaultdict(dict)
    for _, url, html in pages:
        blocks = sitetree.page_blocks(html)
        clean = [b for b in blocks if not b.noise] or blocks
        body = tuple(b.text for b in clean if b.main) or tuple(b.text for b in clean)
        hosts[url.split("/")[2] if url else ""].setdefault(body, []).append(blocks)
    seen = 0
    for host, bodies in hosts.items():
        if any(len({str([(b.path, b.text) for b in blocks]) for blocks in same}) > 1 for same in bodies.values()):
            continue  # which of two layouts of one body counts is left open
        texts, layouts, counts, main = defaultdict(Counter), defaultdict(Counter), Counter(), set()
        for same in bodies.values():
            children = defaultdict(list)
            for block in same[0]:
                parent, _, tag = block.path.rpartition("/")
                children[parent].append(tag)
                children[block.path] = children[block.path]
                main.update([block.path] if block.main else [])
            for path, text in {(b.path, b.text) for b in same[0]}:
                texts[path][text] += 1
            for path, tags in children.items():
                layouts[path][tuple(tags)] += 1
                counts[path] += 1
        for path, seen_texts in texts.items():
            size = math.log(max(counts[path], 2))
            content = max(0.0, 1 - sum(map(math.log, seen_texts.values())) / len(seen_texts) / size)
            spread = sum(n * math.log(n) for n in layouts[path].values())
            shape = max(0.0, 1 - spread / counts[path] / size) if counts[path] > 1 else 1.0
            found = got.pop((host, sitetree._key(path)))
            assert found[:2] == (path in main, counts[path])
            assert found[2] == pytest.approx(sitetree.CONTENT_WEIGHT * content + (1 - sitetree.CONTENT_WEIGHT) * shape)
            seen += 1
    assert seen >= 4


def test_parts_of_large_hosts_change_nothing(spark, monkeypatch):
    frame, pages = site(spark)
    frame = frame.unionByName(frame).repartition(3)
    whole = sorted(tuple(r) for r in sitetree.extract_main_text(frame).collect())
    assert len(whole) == 2 * len(pages)
    monkeypatch.setattr(sitetree, "PART_PAGES", 4)
    per_host = Counter(url.split("/")[2] if url else "" for _, url, _ in pages)
    found = sitetree._large_hosts(frame.withColumn("host", sitetree.host_of(F.col("url")))).collect()
    assert sorted(r["parts"] for r in found) == sorted(-(-2 * n // 4) for n in per_host.values() if 2 * n > 4)
    assert sorted(tuple(r) for r in sitetree.extract_main_text(frame).collect()) == whole
    monkeypatch.setattr(sitetree, "LARGE_HOSTS", 1)
    assert sorted(tuple(r) for r in sitetree.extract_main_text(frame).collect()) == whole
