"""Vector codes, BPE and resampling against plain versions and the library, on given tables and on small awkward ones."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from tribuna.llm import bpe, resample, vectorcodes  # noqa: E402
from tribuna.llm.queries import llm_queries  # noqa: E402
from tribuna.llm.tokens import vocabulary_path  # noqa: E402

SF = "/root/testdata/sf0.001"
Q = llm_queries()


# --- 11: vector codes --------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 12), st.integers(1, 30), st.integers(1, 300), st.randoms())
def test_nearest_entry_is_exact(d, k, n, most, rnd):
    x = np.array([[rnd.randint(-most, most) for _ in range(d)] for _ in range(n)])
    c = np.array([[rnd.randint(-most, most) for _ in range(d)] for _ in range(k)])
    dist = ((x[:, None] - c[None]) ** 2).sum(2)
    at, scaled = vectorcodes.nearest(vectorcodes.walsh(x), vectorcodes.walsh(c))
    n_padded = vectorcodes.walsh(c).shape[1]
    assert at.tolist() == dist.argmin(1).tolist() and (scaled == n_padded * dist.min(1)).all()


def test_transform_is_in_sequency_order():
    for n in (1, 2, 4, 8, 16):
        h = vectorcodes.walsh(np.eye(n, dtype=np.int64)).T
        assert [(a[1:] != a[:-1]).sum() for a in h] == list(range(n))
        assert (h @ h.T == n * np.eye(n)).all()


def plain_codes(rows, parts, entries, rounds, scale):
    """Product codes of rows ``(vec_id, vector)`` by plain loops."""
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = next((len(v) for _, v in good if v and len(v) % parts == 0), None)
    fit = [(i, v) for i, v in good if len(v) == dim and max(map(abs, v)) <= vectorcodes.LARGEST]
    out = [(i, None, None) for i, v in good if (i, v) not in fit]
    if not fit:
        return out, None
    d = dim // parts
    cut = [[tuple(v[p * d : p * d + d]) for p in range(parts)] for _, v in fit]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        return [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    for (i, _), f in zip(fit, assign()):
        out.append((i, bytes(k for _, k in f).hex(), sum(far for far, _ in f)))
    return out, books


def awkward_vectors(seed=3):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice((-1.5, -0.25, 0.0, 0.25, 1.0, rnd.uniform(-2, 2))) for _ in range(6)], i % 3 or None) for i in range(80)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], 2), (None, rows[9][1], 2)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.5, None, 0.0, 0.0, 0.0, 0.0], 1), (103, [float("nan")] * 6, 1), (104, [float("inf")] * 6, 1)]
    rows += [(-5, [1.0] * 4, 2), (105, [1e9] * 6, 2), (106, [0.5] * 12, None)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts,entries,rounds", [(3, 4, 2), (2, 200, 1), (6, 1, 2)])
def test_vector_codes_on_awkward_rows(spark, parts, entries, rounds):
    rows = awkward_vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int").repartition(4)
    books = vectorcodes.train(df, parts=parts, entries=entries, rounds=rounds)
    coded = vectorcodes.encode(df, books, carry=["label", "code", "error"])
    want, entries_ = plain_codes([r[:2] for r in rows], parts, entries, rounds, 256)
    assert books.entries.tolist() == [[list(e) for e in b] for b in entries_]
    got = vectorcodes.with_label_error(coded, F.col("row.label")).collect()
    assert Counter((r.vec_id, r.code, r.error) for r in got) == Counter(want)
    total = Counter()
    for r in got:
        total[r.label] += r.error or 0
    assert all((r.label_error or 0) == total[r.label] for r in got)
    back = {(r.vec_id, None if r.x is None else tuple(r.x)) for r in vectorcodes.decode(coded, books).collect()}
    by_hand = {(i, None if c is None else tuple(x / 256 for p, k in enumerate(bytes.fromhex(c)) for x in entries_[p][k])) for i, c, _ in want}
    assert back == by_hand


def test_vector_codes_of_nothing(spark):
    schema = "vec_id long, embedding array<double>, label int"
    for rows in ([], [(1, None, 1)], [(1, [1.0, 2.0, 3.0], 1)]):
        df = spark.createDataFrame(rows, schema)
        books = vectorcodes.train(df)
        assert books is None
        got = vectorcodes.encode(df, books, carry=["label"]).collect()
        assert [(r.vec_id, r.code, r.error) for r in got] == [(i, None, None) for i, v, _ in rows if v is not None]


# --- 12: BPE -----------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(vocabulary_path(bpe.VOCABULARY))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path(bpe.VOCABULARY))


def same(codec, library, text):
    ids = np.frombuffer(codec.encode([text])[0], dtype="<u4").tolist()
    want = library.encode(text, add_special_tokens=False).ids
    assert ids == want, text[:80]
    assert codec.decode(codec.encode([text])[0]) == library.decode(want, skip_special_tokens=False)


AWKWARD = [
    "", " ", "\n\n  \t x", "it's we'll I'VE 'tis", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext", "Zoë naïve ß ﬁ",
    "数据 处理 テスト 한국어", "עברית العربية हिन्दी", "👩‍👩‍👧 x🙂🙂", "à́b​ c　d\x85e\x1cf\x1fg", "١٢٣ ½ ²³ Ⅷ", "\U0001e4d0꟎Ᲊ ౜", "\x00\x01\x7f�",
    "x" * 5000, "ab" * 3000 + " " + "é" * 900, " " * 700 + "end" + "\n" * 300, "=-" * 400, "".join(map(chr, range(32, 0x250))),
]


@pytest.mark.parametrize("text", AWKWARD, ids=range(len(AWKWARD)))
def test_bpe_equals_the_library(codec, library, text):
    same(codec, library, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.sampled_from(["'ll", " the", "<|endoftext|>", "\n", "  ", "1234", "...", "ing", " "])), max_size=12))
def test_bpe_equals_the_library_on_any_text(codec, library, parts):
    same(codec, library, "".join(parts))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abehinrstuo é", max_size=120))
def test_scan_and_heap_merge_alike(codec, text):
    word = text.encode()
    if word:
        for at, ids in codec.scan([word, word[::-1], word]):
            at, word = at.tolist(), word[::-1]
            assert at == codec.linked_boundaries(word[::-1]) and [codec.bytes_of[i] for i in ids.tolist()] == [word[::-1][a:b] for a, b in zip(at, at[1:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 50300), max_size=12))
def test_any_ids_decode_as_in_the_library(codec, library, ids):
    assert codec.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_long_words_take_no_quadratic_time(codec, library):
    import time

    start = time.perf_counter()
    same(codec, library, "".join(random.Random(1).choice("etaoinshr") for _ in range(300_000)))
    assert time.perf_counter() - start < 20


def test_bpe_query_and_round_trip(spark, library):
    rows = [(i, t, "y", b"z") for i, t in enumerate([None, *AWKWARD, *AWKWARD[:3]])] + [(None, "x", "y", b"z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids binary").repartition(3)
    encoded = bpe.encode(df)
    back = {r.doc_id: r.text for r in bpe.decode(encoded).collect()}
    assert back == {i: t or "" for i, t, *_ in rows}
    for r in encoded.collect():
        want = library.encode(dict((i, t) for i, t, *_ in rows)[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), dtype="<u4").tolist() == want and r.n_tokens == len(want)
    assert bpe.encode(df.limit(0), decoded=True).count() == 0
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q["op12_bpe"][0](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Codec(vocabulary_path("word_bpe_49k.json"))


# --- 13: resampling ----------------------------------------------------------


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c > "\x7f" or c.isascii() and c.isalnum() else " " for c in lower).split(" ")


def plain_resample(rows, target, percent, min_words, longest, buckets, seed):
    def found(text):
        w = [x for x in plain_words(text) if x]
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(found(text)[1])
    for text in target:
        t.update(found(text)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        n, at = found(text)
        weight = sum(gain[b] for b in at) // len(at) if at else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(at), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[5] = k + 1
    return Counter(map(tuple, out))


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(8)
    some = lambda n: " ".join(rnd.choice(["the", "Of", "naïve", "x1", "a-b", "ÉCOLE", "İx", "data z"] + [f"w{i}" for i in range(60)]) for _ in range(n))
    rows = [(i, some(rnd.randrange(60))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " ,;\n"), (203, some(9000)), rows[3], rows[3], (None, some(30)), (None, some(30))]
    return rows, [some(20) for _ in range(9)] + [None, "the of the of"]


@pytest.mark.parametrize("longest,percent,min_words", [(1, 10, 20), (3, 50, 0), (2, 100, 20), (1, 0, 20), (1, 90, 10**6)])
def test_resample_equals_a_plain_version(spark, odd_texts, longest, percent, min_words):
    rows, target = odd_texts
    df = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], "doc_id long, text string, score int, below string, row int").repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(df, goal, percent, min_words, longest, buckets=500, seed=7).collect()
    want = plain_resample(rows, target, percent, min_words, longest, 500, 7)
    assert Counter(tuple(r) for r in got) == want


def test_resample_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resample.resample(df, goal).count() == 0
    some = spark.createDataFrame([(1, "a " * 30), (2, "b " * 30)], "doc_id long, text string")
    assert sorted(r["rank"] for r in resample.resample(some, df, percent=100).collect()) == [1, 2]


def test_cutoff_is_the_exact_key(spark, monkeypatch):
    """Partitions of all sizes and orders, a third of the keys alike in all but the last column."""
    monkeypatch.setattr(resample, "REST_KEYS", 5)
    monkeypatch.setattr(resample, "GROUP_KEYS", 300)
    rnd = random.Random(2)
    keys = [(rnd.randrange(-50, 50), False, rnd.randrange(9), i) for i in range(1500)] + [(3, True, None, i) for i in range(1500, 2300)]
    order = sorted(keys, key=lambda k: (k[0], k[1], k[2] or 0, k[3]))
    df = spark.createDataFrame(keys, "below long, no_id boolean, doc_id long, row long").repartitionByRange(5, "doc_id")
    for m in (1, 700, 1300, 2300):
        assert resample.cutoff(df, m) == order[m - 1]
    assert resample.cutoff(df, 2301) is None and resample.cutoff(df, 0) is None


def test_each_round_discards_a_quarter_at_least():
    rnd = random.Random(4)
    for _ in range(50):
        groups = [sorted(rnd.sample(range(10**6), rnd.randrange(1, 200))) for _ in range(rnd.randrange(1, 12))]
        found = [(1, len(g), (g[(len(g) - 1) // 2], False, 0, 0)) for g in groups]
        pivot, n = resample.weighted_median(found)[0], sum(map(len, groups))
        upto = sum(x <= pivot for g in groups for x in g)
        assert upto >= n / 4 and n - upto >= n / 4 - len(groups)
