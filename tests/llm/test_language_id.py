"""Language identification step by step against plain Python."""

from __future__ import annotations

import math
import random
import re
import time

import numpy as np
import pytest

from scoreloom.llm import language_id as L
from scoreloom.llm.common import prepare

OLD = re.compile(r"<!--.*?-->|<(script|style|nav|footer|template|noscript)\b.*?</\1\s*>", re.I | re.S)


def test_page_text_is_what_the_pattern_says():
    rng = random.Random(4)
    bits = ["<!--", "-->", "<script>", "</script >", "<SCRIPT", "</Script>", "<nav x>", "</nav>", "word ", "<p>", "a < b ", ">", "<navy>", "<footer", "</footer>", "&amp;"]
    for _ in range(3000):
        page = "".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        want = " ".join(L.markup.unescape(L._TAG.sub(" ", OLD.sub(" ", page))).split())
        assert L.page_text(page) == want, page


@pytest.mark.parametrize("bit", ["<!--", "<nav>", "<script", "<a", "<a <!-- </script", "<nav><!--", "</nav ", "<"])
def test_hostile_pages_take_linear_time(bit):
    page = bit * (1_000_000 // len(bit))
    start = time.perf_counter()
    L.page_text(page)
    assert time.perf_counter() - start < 2


def plain_priors(verdicts, classes, smoothing):
    def share(rows, prior):
        n = [sum(v == c for _, v in rows) for c in classes]
        return [(a + smoothing * p) / (sum(n) + smoothing) for a, p in zip(n, prior)]

    found = {}
    for host in {h for h, _ in verdicts}:
        parts = host.split(".")
        parent, top = ".".join(parts[-2:]), parts[-1]
        levels = [
            verdicts,
            [r for r in verdicts if r[0].split(".")[-1] == top],
            [r for r in verdicts if ".".join(r[0].split(".")[-2:]) == parent],
            [r for r in verdicts if r[0] == host],
        ]
        p = [1 / len(classes)] * len(classes)
        for rows in levels:
            p = share(rows, p)
        found[host] = p
    return found


HOSTS = ["a.b.de", "c.b.de", "b.de", "x.de", "y.com", "www.y.com", "", "localhost"]


def test_host_priors(spark):
    rng, classes = random.Random(2), ["de", "en", "und"]
    verdicts = [(rng.choice(HOSTS), rng.choice(["de", "de", "en", "und"])) for _ in range(200)]
    got = L.host_priors(spark.createDataFrame(verdicts, "host string, verdict string"), classes, 5.0).collect()
    want = plain_priors(verdicts, classes, 5.0)
    assert {r.host for r in got} == set(want)
    for r in got:
        assert [math.exp(r[f"prior_{i}"]) for i in range(3)] == pytest.approx(want[r.host])


def test_fusion(spark):
    prepare(spark)
    rng = random.Random(8)
    words = {"de": "der die und nicht ist ein haus".split(), "en": "the and not is a house of".split(), "fr": "le la et pas est une maison".split()}
    languages = tuple(words)
    train = [(" ".join(rng.choices(words[x], k=30)), x) for x in languages for _ in range(20)]
    model = L.fit(spark.createDataFrame(train, "text string, lang string"), languages)
    rows = []
    for i in range(120):
        mixed = rng.choices(words[rng.choice(languages)] + words[rng.choice(languages)], k=rng.randrange(1, 6))
        text = rng.choice([" ".join(mixed), "0x%030x" % rng.getrandbits(120), "", None, "ab"])
        rows.append((i, text, rng.choice([None, "de-AT", "EN", "xx"]), rng.choice([None, "http://h.de/fr/x", "http://h.fr/", "http://h.com/"]), rng.choice(HOSTS)))
    df = spark.createDataFrame(rows, "doc_id int, text string, tag string, url string, host string")
    got = {r.doc_id: r for r in L.identify(df, model, declared=L.F.col("tag"), address=L.F.col("url"), host=L.F.col("host")).collect()}
    classes = [*languages, "und"]

    def found_in(value, trust):
        if value not in languages:
            return [math.log(1 / 3)] * 4
        return [math.log(trust) if value == x else math.log((1 - trust) / 2) for x in languages] + [math.log(1 / 3)]

    own = {}
    for i, text, tag, url, host in rows:
        if not (text or "").strip():
            continue
        tag = tag and tag.split("-")[0].lower()
        path = url and re.search(r"://[^/]*/([a-z]{2})(/|$)", url)
        by_url = None if url is None else path.group(1) if path and path.group(1) in languages else {"de": "de", "fr": "fr"}.get(url.split("/")[2].split(".")[-1])
        own[i] = np.asarray(model.likelihoods(text)) + found_in(tag, L.DECLARED_TRUST) + found_in(by_url, L.ADDRESS_TRUST)
    verdicts = [(r[4], classes[int(np.argmax(own[r[0]]))] if r[0] in own else "und") for r in rows]
    priors = plain_priors(verdicts, classes, L.SMOOTHING)
    for i, _, _, _, host in rows:
        if i not in own:
            assert (got[i].language, got[i].kept, got[i].confidence) == ("und", False, 1.0)
            continue
        scores = own[i] + np.log(priors[host])
        weights = np.exp(scores - scores.max())
        assert got[i].language == classes[int(np.argmax(scores))]
        assert got[i].confidence == pytest.approx(weights.max() / weights.sum())


def test_keys_and_numbers_do_not_outweigh_words(spark):
    """The longer the training text, the more an unseen trigram used to cost."""
    words = "the quick brown fox jumps over a lazy dog and then it sleeps in the sun".split()
    rng = random.Random(1)
    text = " ".join(rng.choices(words, k=30)) + " sk_live_" + "".join(rng.choices("0123456789abcdefXYZ", k=64))
    for copies in (20, 20000):
        train = spark.range(copies).selectExpr(f"'{' '.join(words)}' text", "'en' lang")
        model = L.fit(train, ("en", "de"))
        assert int(np.argmax(model.likelihoods(text))) == 0
        junk = model.likelihoods("".join(rng.choices("0123456789abcdefXYZ~{}", k=80)))
        assert junk[2] > junk[0]
