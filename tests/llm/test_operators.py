"""Every operator against a brute-force version or an exact round trip, on a table of awkward rows."""

from __future__ import annotations

import gc
import hashlib
import json
import math
import random
import re
import weakref
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotemill.llm import (
    bpe, components, mixing, near_dedup, neighbours, quality, sentence_spans, shared, suffix_dedup, token_output, toxicity,
    url_filter,
)
from quotemill.llm.queries import tokenizer_path
from quotemill.llm.shared import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string, ranges string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    words = ["alder", "birch", "cedar", "Dogwood", "élan", "fir,", "ginkgo.", "hazel", "ivy", "juniper!", "kauri", "larch"]
    return " ".join(rng.choice(words) + rng.choice(["", "s", "x", "ing"]) for _ in range(n))


def texts():
    rng = random.Random(3)
    long_one, passage = prose(rng, 400), prose(rng, 60)
    edited = long_one.split()
    edited[200] = "changed"
    return [
        None, "", "   \n\t ", "one", "four words and nothing", "four words and nothing", long_one, long_one, long_one.upper(),
        " ".join(edited), " ".join(edited[:390]), prose(rng, 80) + "\n" + passage + "\n" + prose(rng, 70),
        prose(rng, 30) + " " + passage, passage, "a" * 700, "ab" * 300, "x <|endoftext|> y<|startoftext|>z", "\u0301e \x85 \x1c 漢字🙂",
        "same line\nsame line\nsame line\nother", "$$$ ### *** " * 40, "12 34 56 " * 60, prose(rng, 3000), "ha " * 80,
    ]


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None, "x", None, "y") for i, t in enumerate(texts())]
    return [*found, found[6], (None, texts()[6], None, "s1", 3, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def pairs_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_duplicates(docs, rows, empty):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[find(i)] = find(j)
    want = Counter()
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        name = min(ids, default=None) if sets[i] else r[0]
        want[r[0], len(sets[i]), name, r[0] == name] += 1
    assert pairs_of(near_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    assert near_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 7])
def test_family_of_variants(spark, monkeypatch, block):
    """Variants of one text, most of them not linked, are compared in blocks and lose no link."""
    prepare(spark)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng, rows = random.Random(3), []
    for i in range(160):
        words = [f"w{k}" for k in range(300)]
        for _ in range(rng.choice([2, 4, 6, 8, 10])):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    sets, name = [shingles(text) for _, text in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]) and name[i] != name[j]:
                low, high = sorted((name[i], name[j]))
                name = [low if n == high else n for n in name]
    compared, family_pairs = [], near_dedup.family_pairs
    monkeypatch.setattr(near_dedup, "family_pairs", lambda *a: compared.append(1) or family_pairs(*a))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(name))
    assert compared and len(set(name)) > 100


@pytest.mark.parametrize("percent", [5, 50, 70, 80, 85, 95, 100])
def test_bands_and_signatures_miss_as_stated(percent):
    bands, rows = near_dedup.banding(percent)
    n, s = max(near_dedup.MINIMA, bands * rows), percent / 100
    assert (1 - s**rows) ** bands <= 1 / near_dedup.MISS
    below = sum(math.comb(n, k) * s**k * (1 - s) ** (n - k) for k in range(near_dedup.least_agreeing(percent, n)))
    assert below <= 1 / near_dedup.MISS


def test_one_document_of_each_group_stays(docs):
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert pairs_of(kept.where("doc_id in (4, 5, 6, 7, 8, 9, 10)"), "doc_id") == {(4,): 1, (6,): 1, (8,): 1}


def test_variants_under_null_and_equal_ids_leave_one(spark):
    prepare(spark)
    rng = random.Random(9)
    base = [[f"{rng.random():.9f}" for _ in range(400)] for _ in range(3)]
    ids = [[None] * 4, [7] * 4, [None, 9, 9, 8]]
    rows = [(i, " ".join([*b, f"end{k}"]), g) for g, (b, some) in enumerate(zip(base, ids)) for k, i in enumerate(some)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, g int")
    kept = near_dedup.keep_one(docs).collect()
    assert sorted((r.g, r.doc_id) for r in kept) == [(0, None), (1, 7), (2, 8)]


@pytest.mark.parametrize("percent", [85, 80])
def test_a_family_of_variants_that_are_mostly_not_linked(spark, percent):
    """Variants of one text share all buckets; those left by the first round are told apart by longer signatures."""
    rng = random.Random(percent)
    base, found = [f"w{i}" for i in range(300)], []
    for i in range(120):
        words = list(found[-1] if i % 6 == 5 else base)
        for at in rng.sample(range(300), 3 if i % 6 == 5 else rng.choice([6, 9, 12, 15])):
            words[at] = f"x{i}_{at}"
        found.append(words)
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in found]
    least = list(range(120))
    linked = [(a, b) for a in range(120) for b in range(a) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(120):
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    assert len(set(least)) > 10 and linked
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(found)], "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(least))


@pytest.mark.parametrize("percent", [80, 85, 99])
def test_bits_differ_as_rarely_as_stated(percent):
    d, n = near_dedup.most_differing(percent, 512), 512
    p = (100 - percent) / 200

    def tail(k):
        return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1, n + 1))

    assert tail(d) <= 1 / near_dedup.MISS < tail(d - 1)
    assert near_dedup.most_differing(100, n) == 0


def test_components_of_a_path_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    found = components.components(spark.createDataFrame(edges, "u int, v int")).collect()
    assert {r.node: r.component for r in found} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


def test_repeated_strings(docs, rows, empty):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    n = suffix_dedup.LENGTH
    seen = Counter(b[i : i + n] for _, b in raw for i in range(len(b) - n + 1))
    want = Counter()
    for doc_id, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, y in zip(b, gone) if not y)
        want[doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    found = suffix_dedup.digests(docs)
    assert pairs_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    cleaned = suffix_dedup.clean_documents(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert suffix_dedup.digests(empty).count() == 0


def test_common_names_are_counted_by_window(docs, monkeypatch):
    want = pairs_of(suffix_dedup.digests(docs), "doc_id", "n_removed", "kept_sha256")
    monkeypatch.setattr(suffix_dedup, "HOT", 1)
    assert pairs_of(suffix_dedup.digests(docs), "doc_id", "n_removed", "kept_sha256") == want


def test_repeated_ranges_are_written_once(docs, monkeypatch):
    """Each file that a task writes starts helper processes, which may be counted with its executor's memory."""
    labels, land = [], suffix_dedup.land
    monkeypatch.setattr(suffix_dedup, "land", lambda df, label: labels.append(label) or land(df, label))
    assert suffix_dedup.digests(docs).count() == docs.count()
    assert labels == ["coarse", "ranges", "fine", "hot", "marks"]


def test_blocks_of_texts_do_not_pile_up():
    """A block is some ten times its text; a worker must be rid of it before it makes the next."""
    rng = random.Random(5)
    found = []
    gc.disable()
    try:
        for make in (suffix_dedup._coarse, suffix_dedup._fine):
            block = suffix_dedup.Block([(1, 0, prose(rng, 200).encode())], suffix_dedup.LENGTH)
            make(block)
            found.append(weakref.ref(block))
            del block
        assert [x() for x in found] == [None, None]
    finally:
        gc.enable()


def test_mix(docs, rows, empty):
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    assert Counter(r.size for r in found) == Counter(len(WORD.findall(r[1] or "")) for r in rows)
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, found))
    sources = {r.source: (r.source_size, r.target) for r in found}
    assert sum(t for _, t in sources.values()) == pytest.approx(1.5 * sum(s for s, _ in sources.values()))
    for r in found:
        assert r.taken == r.copies * r.size <= 2 * r.size and r.target <= 2 * r.source_size
    for source, (_, target) in sources.items():
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - target) <= max(r.size for r in mine)
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in found)
    assert mixing.mix(empty).count() == 0


def test_targets_are_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 90), ("d", 0)], "source string, source_size long")
    left, weights, open_ = 1800.0, {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}, {"a": 10, "b": 100, "c": 1000, "d": 0, None: 90}
    want = {}
    while True:
        share = {s: left * weights[s] / sum(weights[o] for o in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * open_[s]]
        if not full:
            break
        for s in full:
            want[s] = 2 * open_[s]
            left -= want[s]
            del open_[s], share[s]
    want |= share
    assert {r.source: r.target for r in mixing.targets(sizes).collect()} == pytest.approx(want)


def embeddings(spark, extra=()):
    rng = np.random.default_rng(1)
    found = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)]
    found += [(1000 + i, found[3][1]) for i in range(60)]
    return spark.createDataFrame([*found, *extra], "vec_id long, embedding array<float>"), found


def test_nearest_neighbours(spark):
    prepare(spark)
    odd = [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] * 8), (2080, [1.0]), (None, [1.0] * 8)]
    table, rows = embeddings(spark, odd)
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], dtype=np.float32).astype(float)
    found = neighbours.nearest(table, list_size=20, max_probes=16).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r)
    assert sorted(by) == [i for i in sorted(ids) if i % 20 == 0]
    hits = 0
    for q, got in by.items():
        score = v @ v[ids == q][0]
        others = [(-s, i) for s, i in zip(score, ids) if i != q]
        got = sorted(got, key=lambda r: r.rank)
        assert [r.rank for r in got] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        hits += len({i for _, i in sorted(others)[:20]} & {r.vec_id for r in got})
        assert all(r.score == pytest.approx(score[ids == r.vec_id][0], abs=1e-12) for r in got)
    assert hits / (20 * len(by)) >= 0.9
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_neighbours_are_exact_over_hundreds_of_lists(spark):
    prepare(spark)
    v = np.random.default_rng(7).normal(size=(8000, 64))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    found = neighbours.nearest(table, every=200, list_size=20).collect()
    exact, want = v.astype(float), set()
    for q in range(0, len(v), 200):
        score = exact @ exact[q]
        score[q] = -np.inf
        want |= {(q, rank + 1, int(i)) for rank, i in enumerate(np.lexsort((np.arange(len(v)), -score))[:20])}
    assert {(r.query_id, r.rank, r.vec_id) for r in found} == want


def test_few_vectors_are_all_found(spark):
    prepare(spark)
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert neighbours.nearest(few).count() == 4


def test_encoding_and_decoding(docs, rows, empty):
    library = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], tuple(ids), library.decode(ids, skip_special_tokens=False)] += 1
    found = bpe.encode_documents(docs, tokenizer_path()).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == want
    digests = bpe.digests(docs, tokenizer_path()).collect()
    spelt = Counter((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()) for i, ids, _ in want.elements())
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in digests) == spelt
    assert bpe.digests(empty, tokenizer_path()).count() == 0


def test_trie_on_random_strings():
    rng, library = random.Random(5), Tokenizer.from_file(tokenizer_path())
    letters = "aabeilnorstth'.!1é\u0301ßΣ漢 \t\x0b\x85"
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    want = [" ".join(map(str, library.encode(t, add_special_tokens=False).ids)) for t in some]
    assert [ids for ids, _ in bpe.encoder(tokenizer_path()).encode([t.encode() for t in some])] == want


def test_letters_go_through_the_trie_once_whatever_case_and_marks(monkeypatch):
    library, coder, walked = Tokenizer.from_file(tokenizer_path()), bpe.Encoder(tokenizer_path()), []
    encode = coder.trie.encode
    monkeypatch.setattr(coder.trie, "encode", lambda words: walked.extend(words) or encode(words))
    for text in ["Marmot, marmot", "MARMOT!! Ébène", "marmot. ébène; x\u0301 't marmot's<|endoftext|>"]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(coder.encode([text.encode()])) == [(" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
    assert walked.count("marmot") <= 2  # once as letters, once in a chunk that the library cuts
    assert walked.count("ébène".encode().decode("latin-1").translate(bpe.SPELLING)) == 1


def test_a_full_cache_of_the_trie_keeps_chunks_at_hand(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 5)
    library, coder = Tokenizer.from_file(tokenizer_path()), bpe.Encoder(tokenizer_path())
    for text in ["one two three four", "Two five six seven! two", "eight two", "one"]:
        ((found, _),) = coder.encode([text.encode()])
        assert found == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))
        assert b"two" in coder.chunks or text == "one"


def test_other_tokenizers_cut_marks_by_their_own_rules(tmp_path):
    content = json.loads(Path(tokenizer_path()).read_text(encoding="utf-8"))
    assert shared.cuts_letters(content)
    content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}]+[.!]?|[\p{N}]|[^\s\p{L}\p{N}]"
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content), encoding="utf-8")
    library, text = Tokenizer.from_file(str(path)), "Marmot. marmot!! (marmot) 12"
    ids = library.encode(text, add_special_tokens=False).ids
    assert not shared.cuts_letters(content) and ids != Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    (found,) = token_output.LibraryEncoder(str(path)).encode([text.encode()])
    assert np.frombuffer(found, dtype="<u4").tolist() == ids
    ((spelt, _),) = bpe.Encoder(str(path)).encode([text.encode()])
    assert spelt == " ".join(map(str, ids))


def test_token_files(docs, rows, empty):
    library, start = Tokenizer.from_file(tokenizer_path()), 0
    want = {}
    for r in sorted((r for r in rows if r[0] is None), key=str):
        start += len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1
    for i in sorted({r[0] for r in rows if r[0] is not None}):
        mine = [r for r in rows if r[0] == i]
        ids = np.array([*library.encode(mine[0][1] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids) * len(mine)
    found = token_output.round_trip(docs, tokenizer_path()).where("doc_id is not null").collect()
    first = {}
    for r in found:
        row = (r.start, r.n_tokens, r.ids_crc32)
        first[r.doc_id] = min(first.get(r.doc_id, row), row)
    assert first == want and len(found) == len(rows) - 2
    assert token_output.round_trip(empty, tokenizer_path()).count() == 0


def test_chunks_encoded_together_are_encoded_as_if_alone(monkeypatch):
    monkeypatch.setattr(token_output, "JOINED", 3)
    library, encode = Tokenizer.from_file(tokenizer_path()), token_output.LibraryEncoder(tokenizer_path()).encode
    texts = [
        "a bc don't 12 ÉİSS x\u0301 \u0301y", "<|startoftext|> a<|startoftext|>b <|endoftext|> b<|endoftext|>",
        "", "z \u3000 \x85 \x1c w\xa0v", "bc bc<|start oftext|>",
    ]
    for text, found in zip(texts, encode([t.encode() for t in texts])):
        assert np.frombuffer(found, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


class Counted:
    """A library tokenizer that keeps the texts it encodes."""

    def __init__(self, library):
        self.library, self.texts = library, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.library.encode_batch_fast(texts, **options)


def test_the_library_encodes_letters_once_whatever_case_and_marks():
    library, encoder = Tokenizer.from_file(tokenizer_path()), token_output.LibraryEncoder(tokenizer_path())
    encoder.library = counted = Counted(encoder.library)
    texts = ["Marmot, (marmot) MARMOT!!", "marmot. Ébène ébène* 'marmot's x\u0301", "ÉBÈNE marmot;"]
    for text, found in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(found, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    cut = " ".join(counted.texts).lower().replace("<|startoftext|>", " ").replace("<|endoftext|>", " ").split()
    assert cut.count("marmot") == 1 and cut.count("ébène") == 1


def test_a_full_cache_of_chunks_keeps_those_of_the_texts_at_hand(monkeypatch):
    monkeypatch.setattr(token_output, "MAX_WORDS", 5)
    library, encoder = Tokenizer.from_file(tokenizer_path()), token_output.LibraryEncoder(tokenizer_path())
    for text in ["one two three four", "Two five six seven! two", "eight two", "one"]:
        (found,) = encoder.encode([text.encode()])
        assert np.frombuffer(found, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert b"two" in encoder.chunks or text == "one"


@pytest.mark.parametrize("plane", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, token_output.BLOCK, token_output.BLOCK + 3])
def test_planes(plane, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, size=n, dtype=np.uint32)
    ends, payload = token_output.pack(ids, plane, 1)
    assert (token_output.unpack(n, ends, payload, plane) == ids).all()


def test_sentence_spans(docs, rows, empty):
    found = sentence_spans.remove_repeats(docs).collect()
    seen, first = set(), {}
    order = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows}, key=lambda x: x[:2])
    for _, doc_id, text in order:  # equal ids have equal texts here, but for the null id
        cut = sentence_spans.sentences(text.encode())
        words, gone = [s.lower().split() for s in cut], set()
        for i in range(len(cut)):
            for end in range(i + sentence_spans.MIN_SENTENCES, len(cut) + 1):
                if sum(map(len, words[i:end])) >= sentence_spans.MIN_WORDS:
                    if words[i]:
                        key = str(words[i:end])
                        gone |= set(range(i, end)) if key in seen or first.setdefault(key, (doc_id, i)) != (doc_id, i) else set()
                    break
        if doc_id and text:
            got = {r.text for r in found if r.doc_id == doc_id}
            assert got == {b"".join(s for i, s in enumerate(cut) if i not in gone).decode()} or text == texts()[6]
    assert len(found) == len(rows)
    assert {r.doc_id for r in found if r.doc_id == 13 and r.removed} == {13}
    assert b"".join(sentence_spans.sentences(texts()[21].encode())) == texts()[21].encode()
    assert sentence_spans.remove_repeats(empty).count() == 0


def test_cuts_of_a_long_sentence_need_no_arrays(monkeypatch):
    """At the last of the least hashes of each window, without an array for every sentence."""
    rng = random.Random(4)
    long_ones = [[rng.choice([b"ab ", b"cd ", b"Ef  ", b"g\t"]) for _ in range(n)] for n in (26, 27, 40, 90)]
    long_ones += [[b"same "] * 60, [b"w%d " % rng.randrange(99) for _ in range(200)]]
    width = sentence_spans.WINDOW
    monkeypatch.setattr(sentence_spans, "np", None)
    for words in long_ones:
        h = [xxhash.xxh3_64_intdigest(w.strip().lower()) for w in words]
        want = {max(i for i in range(a, a + width) if h[i] == min(h[a : a + width])) for a in range(len(h) - width + 1)}
        assert list(sentence_spans._cuts(words)) == sorted(want - {0})


def test_every_repeated_run_of_sentences_goes(spark):
    prepare(spark)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    say = lambda n, end="": " ".join(word() for _ in range(n)) + end
    long_one, ended = say(60), " ".join(say(n, ".") for n in (20, 9, 3, 14, 2, 30, 5, 4))
    made = [f"{say(30 + i)} {long_one} {say(40)}. {say(7, '.')} {ended} {say(9, '.')}" for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in sentence_spans.remove_repeats(docs, tails=True).collect()}
    seen = {}
    for i, text in enumerate(made):
        cut, gone = sentence_spans.sentences(text.encode()), set()
        words = [s.lower().split() for s in cut]
        for a in range(len(cut)):
            for b in range(a + sentence_spans.MIN_SENTENCES, len(cut) + 1):
                if sum(map(len, words[a:b])) >= sentence_spans.MIN_WORDS:
                    if seen.setdefault(str(words[a:b]), (i, a)) != (i, a):
                        gone |= set(range(a, b))
        assert found[i] == b"".join(s for k, s in enumerate(cut) if k not in gone).decode()
        assert not i or len(set(long_one.split()) & set(found[i].split())) <= 2 * sentence_spans.WINDOW
        assert not i or not set(ended.replace(".", "").split()) & set(found[i].replace(".", "").split())


def test_toxicity(spark, empty):
    prepare(spark)
    rng = random.Random(2)
    some = [(i, prose(rng, 60) + (" grobian " if i % 4 == 0 else " ") + prose(rng, 60)) for i in range(400)] + [(None, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in some], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(300)] + [(None, None, 1)], "doc_id long, toxic int, quality int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == 401
    for i, _ in some[:-1]:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert found[i].predicted == (i % 4 == 0) and 0 <= found[i].score <= 1
    assert found[None].predicted == 0
    assert toxicity.toxicity(empty, labels).count() == 0
    assert {r.predicted for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0}


def test_rare_insult_among_many_common_words(spark):
    prepare(spark)
    letters = "abcdefghijk"
    common = " ".join(a + b + c + d for a in letters for b in letters for c in letters for d in letters)  # 29,282 entries with stems
    some = [(i, common + (" grobian" if i % 4 == 0 else "")) for i in range(100)]
    docs = spark.createDataFrame(some, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(100)], "doc_id long, toxic int")
    lexicon, _ = toxicity.learn(docs, labels)
    assert set(lexicon) == {"grobian", "grob*", "grobi*", "grobia*"}


def test_clause_grammar():
    lexicon, known = {"dolt": 8.0}, {}
    plain, aimed, not_so, reported = (
        toxicity.clause_odds(c.split(), lexicon, known)
        for c in ("the dolt came", "you are the dolt", "that is not a dolt", "he said a dolt")
    )
    assert aimed > plain > not_so > 0 and reported < toxicity.clause_odds("he saw a dolt".split(), lexicon, known)
    assert toxicity.clause_odds("kill you".split(), {}, {}) > 1 > toxicity.clause_odds("not kill time".split(), {}, {})


def test_quality(docs, rows, empty):
    found = quality.judge(docs)
    want = Counter()
    for r in rows:
        text = r[1] or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        want[r[0], len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed] += 1
    assert pairs_of(found, *quality.RESULT[:-1]) == want
    verdicts = pairs_of(found, "doc_id", "kept")
    assert pairs_of(quality.judge(docs, list(quality.RULES)[::-1]), "doc_id", "kept") == verdicts
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and kept.count() == sum(n for (_, k), n in verdicts.items() if k)
    assert quality.judge(empty).count() == 0


def test_url_filter(spark):
    urls = [
        (1, "http://A.Example.ORG/es/x?y"), (2, "https://example.org/en/12"), (3, "ftp://b.com/fr/"), (4, "http://b.com/de/#x"),
        (5, "http://spam-farm.net/a"), (6, "http://www.good.net"), (7, None), (8, "no scheme"), (9, "x://org"), (10, "http://spam-farm.net/a"),
        (None, "http://notorg/"), (11, ""),
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in urls], "page_id long, url string, host string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert found[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert found[2][2:] == ("example.org/en/1", "block") and found[3][2:] == ("com/fr/", "allow") and found[4][2:] == ("com/de/", "block")
    assert found[5] == found[10] == ("spam-farm.net", "/a", None, "block") and found[6] == ("www.good.net", "", None, "allow")
    assert found[7] == found[8] == found[11] == ("", "", None, "allow") and found[9] == ("org", "", None, "allow")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_cascade_is_exact_in_shards(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_LEVEL_BITS", 2048)
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.format_string("http://h%s.net/p", "id").alias("url"))
    listed = F.pmod(F.xxhash64("host"), F.lit(7)) == 0
    found = url_filter.judge(pages, listed, rules=())
    assert found.count() == 3000
    assert found.where((F.col("verdict") == "block") != listed).count() == 0


def test_an_encoder_goes_when_another_operator_works_in_its_worker(spark):
    """It held some 300 MB through the stages of all other operators."""
    tasks = []

    class Rows:
        def mapInArrow(self, run, kind):
            tasks.append(run)

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64())})
    for owner in (bpe.__name__, near_dedup.__name__):
        make = eval("lambda batch: {'doc_id': batch.column(0)}", {"__name__": owner})
        shared.map_batches(Rows(), "doc_id long", make)
    encoder = bpe.encoder(tokenizer_path())
    assert list(tasks[0](iter([batch]))) == [batch] and bpe.encoder(tokenizer_path()) is encoder
    assert list(tasks[1](iter([batch]))) == [batch] and not bpe._encoders
