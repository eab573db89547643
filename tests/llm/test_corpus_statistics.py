"""Collocations, decontamination and whitening against brute-force versions on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quotemill.llm import collocations, decontamination, whitening
from quotemill.llm.shared import prepare

SCHEMA = "doc_id long, text string, lang string, n long, key string, phrase string, size string, range string"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def prose(rng, n):
    words = ["alder", "Birch", "cedar", "élan", "fir,", "ginkgo.", "hazel", "ivy", "juniper!", "a\tb", "x y", "ÉCLAT"]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    passage = prose(rng, 30)
    texts = [
        None, "", " \t\n ", "one", ".,;:!?", "ha " * 90, "Ha ha. " * 50, prose(rng, 4000), "x" * 500, "\x00 \x1c \x85 漢字🙂 漢字🙂",
        *(prose(rng, 40) + "\n" + passage + prose(rng, 5) for _ in range(60)), *([prose(rng, 50)] * 45),
    ]
    langs = ["en", "en", None, "und", "fr", "en", "fr"]
    return [(i, t, langs[i % 7], 1, "k", "p", "s", "r") for i, t in enumerate(texts)] + [(None, texts[7], "en", *[None] * 5)] * 2


@pytest.fixture(scope="module")
def docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")


def rank_by_brute_force(rows, least, top):
    f, n, out = defaultdict(Counter), Counter(), []
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + size]
            for p, a in candidates.items() for size in range(2, len(p)) for i in range(len(p) - size + 1)
            if 100 * a >= 80 * c[p[i : i + size]]
        }
        found = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("least", "top", "sample"), [(30, 2000, 4), (30, 7, 1), (3, 2000, 50)])
def test_collocations_equal_brute_force_whatever_the_sample_misses(docs, rows, least, top, sample):
    got = collocations.collocations(docs, least=least, top=top, sample=sample)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == rank_by_brute_force(rows, least, top)


def test_collocations_of_an_empty_table(docs):
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_long_texts_are_cut_into_blocks_without_losing_a_phrase(monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, 300).encode(), b"", b"w " * 200, b"y" * 700 + b" z " + b"v" * 300, b"a.b\nc d e f"]

    def phrases(block):
        monkeypatch.setattr(collocations, "BLOCK", block)
        found = Counter()
        for words in collocations.blocks(texts, ["en"] * len(texts), [1] * len(texts)):
            for size, (key, real) in enumerate(words.keys(), 1):
                found.update((words.phrase(i, size), int(key[i])) for i in np.flatnonzero(real))
        return found

    whole = phrases(1 << 20)
    assert len({p for p, _ in whole}) == len(whole)
    for block in (16, 50, 333):
        assert phrases(block) == whole


def contaminated_by_brute_force(rows, items, window):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(LOW))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    out = []
    for doc_id, text, *_ in rows:
        w, hit, found = word.findall((text or "").translate(LOW)), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if items_here := windows.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= items_here
        ids = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=repr)


def items_of(rows):
    texts = [r[1] for r in rows]
    middle = " ".join(texts[12].split()[8:32])
    return [
        (1, None), (2, ""), (3, "?!"), (4, "Ha HA"), (5, "juniper"), (6, middle), (6, texts[12]), (7, middle), (10, middle.upper()),
        (None, " ".join(texts[7].split()[100:115])), (8, "no such words stand anywhere in these documents at all, none"), (9, texts[7]),
    ]


@pytest.mark.parametrize("window", [10, 3, 2])
def test_contamination_equals_brute_force(spark, docs, rows, window):
    items = items_of(rows)
    benchmark = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, window string, length long")
    got = decontamination.contamination(docs, benchmark, window)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = contaminated_by_brute_force(rows, items, window)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert {r[-1] for r in expected} == {True, False}


def test_contamination_of_empty_tables(spark, docs, rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs.limit(0), spark.createDataFrame(items_of(rows), none.schema)).count() == 0
    clean = decontamination.contamination(docs, none).collect()
    assert len(clean) == len(rows) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in clean)


def test_contamination_runs_no_python(spark, docs, rows):
    plan = decontamination.contamination(docs, spark.createDataFrame(items_of(rows), "item_id long, text string"))
    assert not re.search("Python|Arrow|Pandas", plan._jdf.queryExecution().executedPlan().toString())


def vectors(rng, n, width):
    return (rng.standard_normal((n, width)) * np.linspace(2, 0.5, width) + 0.3) @ rng.standard_normal((width, width)) / 4


def whitened_by_brute_force(c, components):
    x = np.floor(64 * c).astype(object) + 1000000
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    y = (off / n).astype(float)
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return (off**2).sum(axis=1).tolist(), y @ axes / np.sqrt(values), values / np.trace(cov)


@pytest.mark.parametrize(("n", "width"), [(400, 60), (200, 5)])
def test_whitening_equals_the_eigenvectors_of_the_covariance(spark, n, width):
    prepare(spark)
    c = vectors(np.random.default_rng(width), n, width)
    k = min(32, width)
    rows = [(i, row.tolist(), i, "x", 0.5) for i, row in enumerate(c)]
    odd = [None, [], [None] * width, [float("nan")] + [0.0] * (width - 1), [float("inf")] * width, [1.0] * (width + 1)]
    rows += [(1000 + i, v, 0, "y", None) for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n long, component string, whitened double")
    got = whitening.whitened(table.repartition(3)).orderBy("vec_id", "component").toPandas()
    deviations, white, share = whitened_by_brute_force(c, k)
    assert got["vec_id"].tolist() == np.repeat(np.arange(n), k).tolist()
    assert got["component"].tolist() == list(range(1, k + 1)) * n
    assert got["deviation"].tolist() == np.repeat(np.array(deviations), k).tolist()
    found = got["whitened"].to_numpy().reshape(n, k)
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found * sign - white).max() < 1e-9
    assert np.abs(got["explained"].to_numpy().reshape(n, k) / share - 1).max() < 1e-9
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10 and set(got["n"]) == {n}


def test_whitening_of_vectors_without_variance_and_of_huge_ones(spark):
    prepare(spark)
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    alike = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], schema)).collect()
    assert len(alike) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in alike} == {(3, 0, None, 0.0, None)}
    line = whitening.whitened(spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(9)], schema)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in line) and line[0].identity_error < 1e-10
    huge = whitening.whitened(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 5.0])], schema)).collect()
    assert {r.deviation for r in huge} == {None} or all(r.deviation is None or r.deviation >= 0 for r in huge)


def test_leading_vectors_pass_through_the_filter():
    rng = np.random.default_rng(2)
    for values in (np.linspace(3, 1, 90), np.r_[1e6, 40, np.linspace(2, 1.9, 88)], np.r_[np.linspace(5, 1, 40), np.zeros(50)]):
        q = np.linalg.qr(rng.standard_normal((90, 90)))[0]
        v, used = (q * values) @ q.T, []
        got, axes = whitening.leading(lambda x: used.append(x.shape) or v @ x, 90, 10)
        assert np.allclose(got, np.sort(values)[::-1][:10], rtol=1e-12)
        assert np.abs(v @ axes - axes * got).max() < 1e-10 * got[0]
        assert max(s[1] for s in used) == 18
