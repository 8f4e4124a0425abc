"""Quality rules and URL filters against plain Python and SQL."""

import random
import re

import __spark_entry__ as entry
import pytest
from compare import connect, differences

from lawloom.llm import rules, urls
from lawloom.llm.queries import ORACLES

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    assert differences(entry.queries()[name](spark, SMOKE), connect(SMOKE), ORACLES[name]) == []


def test_rules_run_without_python(spark, smoke):
    plan = rules.judge(smoke("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def repeated_words(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    return len({i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(8)}), len(words)


def test_measures_equal_python(spark, odd_docs):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) + rng.choice(["\n", "\x0b", "", "\nab\nab\n \n"]) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in rules.judge(docs).collect():
        text = texts[row.doc_id]
        assert (row.n_repeat_words, row.n_words) == repeated_words(text)
        lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.word_chars == len(re.sub("[ \t-\r]", "", text))
        assert row.base_failed == (row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words)
        assert not (row.base_failed and row.kept)
    got = rules.judge(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.n_words == 0 and not r.kept for r in got if r.doc_id in (1, 2, 3))
    assert rules.judge(odd_docs.limit(0)).count() == 0


def test_policies_and_ablation_read_the_ledger(spark, smoke):
    rows = rules.ledger(smoke("documents")).cache()
    masks = [r.failed for r in rows.collect()]
    for policy in rules.POLICIES:
        bits = rules.mask(policy)
        assert rules.apply_policy(rows, policy).where("kept").count() == sum(not (m & bits) for m in masks)
        for r in rules.ablation(rows, policy).collect():
            assert r.n_failing == sum(bool(m & rules.BIT[r.rule]) for m in masks)
            assert r.n_only_this == sum(m & bits == rules.BIT[r.rule] for m in masks)


def brute(url, table):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, "allow"
    rest = url[at + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda f: (f[0], f[1], f[3]), default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_sweep_equals_brute_force(spark):
    rng = random.Random(5)
    labels = ["org", "com", "example", "a", "b", "www", "xn--x"]
    host = lambda n: ".".join(rng.choice(labels) for _ in range(n))
    path = lambda n: "".join(rng.choice(["/", "a", "en/", "1", ".", "-"]) for _ in range(n))
    table = [(host(rng.randint(1, 3)), "/" + path(rng.randint(0, 3)), rng.choice(["allow", "block"])) for _ in range(120)]
    links = [rng.choice(["http://", "HTTPS://", "", "x"]) + host(rng.randint(1, 4)).upper() + rng.choice(["", ":80", "/" + path(4), "?q=/a", "#f"]) for _ in range(1500)]
    links += [None, "", "://", "http:///p", "a://b://c", "http://org"] + ["http://www.example.org/en/1"] * 800
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(links)], "page_id long, url string, html string")
    # Contradicting rules on one place: block wins.
    merged = {}
    for h, p, v in table:
        merged[h, p] = max(v, merged.get((h, p), ""))
    merged = [(h, p, v) for (h, p), v in merged.items()]
    got = urls.judge(pages, urls.rule_table(spark, table), ranges=9).collect()
    assert len(got) == len(links)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(links[r.page_id], merged), links[r.page_id]
    empty = urls.rule_table(spark, table).limit(0)
    assert {(r.rule, r.verdict) for r in urls.judge(pages, empty).collect()} == {(None, "allow")}
    assert urls.judge(pages.limit(0), urls.rule_table(spark)).count() == 0
