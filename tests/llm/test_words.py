"""Spelling variants, periodic runs and packing against plain versions."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import long_text
from quakeloom.llm import common, packing, periodic, queries, spelling

SF = "/root/testdata/sf0.001"


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def same(df, want, columns):
    assert sorted((tuple(r) for r in df.select(*columns).collect()), key=str) == sorted(want, key=str)


@pytest.fixture(scope="module", params=["documents", "odd", "empty"])
def docs(request):
    return request.getfixturevalue(request.param)


# ---------------------------------------------------------------- word numbers

@pytest.mark.parametrize("most", [1, 7, 64, 1 << 20])
def test_word_numbers_are_exact(odd_rows, most):
    texts = [(t or "") for _, t, *_ in odd_rows] + ["abcd", "efgh ij", "", " k"]
    encoded = [t.encode()[:3000] if most < 64 else t.encode() for t in texts]
    at = np.cumsum([0, *map(len, encoded)])
    ids, offsets, names = common.word_numbers(np.frombuffer(b"".join(encoded), np.uint8), at, most)
    got = [[names[int(i)].as_buffer().to_pybytes() for i in ids[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [[w for w in e.translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w] for e in encoded]


# ---------------------------------------------------------------- spelling variants

SPELLING = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling(docs):
    same(spelling.group(docs, slip=97), brute.spelling(rows_of(docs)), SPELLING)


def test_spelling_of_close_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 20)  # frequent keys are split over tiles
    monkeypatch.setattr(spelling, "BIN", 64)
    monkeypatch.setattr(spelling, "TILE", 16)
    draw = random.Random(5)
    words = ["".join(draw.choice("abé") for _ in range(draw.randrange(4, 8))) for _ in range(9000)]
    rows = [(i, " ".join(words[i::50]) + " Éabab ÉABAB") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = brute.spelling(rows)
    assert max(r[4] for r in got) > 10 and any(r[2] != r[1] for r in got if r[1])
    same(spelling.group(docs, slip=97), got, SPELLING)


def test_words_of_a_long_text_are_counted_in_slices(monkeypatch):
    monkeypatch.setattr(spelling, "SLICE", 100)
    text = long_text(3000) + "x" * 500
    assert spelling._runs(text) == Counter(w.encode("latin-1") for w in __import__("re").findall("[A-Za-zÀ-ÿ]+", text.lower()))


# ---------------------------------------------------------------- periodic runs

PERIODIC = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic(docs):
    same(periodic.digest(periodic.find(docs, periodic.planted)), brute.periodic(rows_of(docs)), PERIODIC)


def longest_lyndon(word):
    """By the definition: the next smaller suffix ends the longest Lyndon word."""
    return [next((j for j in range(i + 1, len(word)) if word[j:] < word[i:]), len(word)) - i for i in range(len(word))]


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_grouping_yields_lyndon_arrays_and_all_runs(letters):
    draw = random.Random(letters)
    for _ in range(300):
        word = [draw.randrange(letters) for _ in range(draw.randrange(1, 50))]
        root = [draw.randrange(letters) for _ in range(draw.randrange(1, 6))]
        word[len(word) // 3:len(word) // 3] = root * draw.randrange(8)
        assert periodic.lyndon(word) == longest_lyndon(word)
        assert sorted(periodic.runs_of(np.array(word)), key=lambda r: (r[0], r[2])) == brute.runs(word)


def test_nested_runs_and_rest(spark):
    text = "x a a a a a a b a a a a a a b a a a a a a b a a a a a a b y"
    (row,) = periodic.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row["runs"]] == brute.runs(text.split()) and len(row["runs"]) == 5
    assert row["collapsed"] == "x a b y"


# ---------------------------------------------------------------- packing

@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def plain_pieces(rows, path, capacity=2048):
    from tokenizers import Tokenizer

    core, out = Tokenizer.from_file(path), []
    for doc_id, text in rows:
        ids = [*core.encode(text or "", add_special_tokens=False).ids, 0]
        out += [(doc_id, i // capacity, i, len(ids[i:i + capacity]), np.array(ids[i:i + capacity], "<u4").tobytes()) for i in range(0, len(ids), capacity)]
    return out


def whole(packed, capacity=2048):
    """The sequences' fill, after a check that nothing overlaps or leaves a gap."""
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_pieces(docs, vocabulary):
    got = [tuple(r) for r in packing.pieces(docs, vocabulary).collect()]
    assert sorted(got, key=str) == sorted(((*p[:4], bytearray(p[4])) for p in plain_pieces(rows_of(docs), vocabulary)), key=str)


def test_odd_chunks_and_small_slices(vocabulary, monkeypatch):
    from tokenizers import Tokenizer

    core, known = Tokenizer.from_file(vocabulary), packing._Chunks(vocabulary)
    monkeypatch.setattr(packing, "SLICE", 5)
    monkeypatch.setattr(packing, "KNOWN", 8)
    for text in ("á ́b  İSTANBUL ΣΑΣ Σ \x1c x\x1cy q it's I'LL 'S 123 1a2 $$ \t\r\n x", " " * 50, "", "ﬁ Å ①½", "a<|endoftext|>b <|startoftext|>", "ß× ÷ ÀÞß 'D'Re it''s\n\nno"):
        assert b"".join(packing.encoded(text, known)) == np.array(core.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_every_symbol_comes_about_by_its_own_merge(vocabulary):
    """What makes merging by the least id the same as the model's rule."""
    with open(vocabulary, encoding="utf-8") as file:
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in json.load(file)["model"]["merges"]]
    rank = {m: i for i, m in enumerate(merges)}
    for a, b in merges:
        word, symbols = a + b, list((a + b).removesuffix("</w>"))
        if word.endswith("</w>"):
            symbols[-1] += "</w>"
        while len(symbols) > 2:
            pair = min(zip(symbols, symbols[1:]), key=lambda p: rank.get(p, len(rank)))
            i, out = 0, []
            while i < len(symbols):
                both = tuple(symbols[i:i + 2]) == pair
                out.append("".join(symbols[i:i + 1 + both]))
                i += 1 + both
            assert len(out) < len(symbols)
            symbols = out
        assert tuple(symbols) == (a, b)


def test_packing(docs, vocabulary):
    cut = packing.pieces(docs, vocabulary)
    packed = packing.pack(packing.digest(cut)).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in packed if r["doc_id"] is not None) == sorted(
        p[:4] for p in plain_pieces(rows_of(docs), vocabulary) if p[0] is not None)
    total = sum(r["length"] for r in packed)
    assert whole(packed) == -(-total // 2048)


def test_sequences_hold_their_pieces_whole(documents, vocabulary):
    packed = packing.pack(packing.pieces(documents, vocabulary))
    by = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert by[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert sum(map(len, by.values())) == 4 * sum(r["length"] for r in packed.collect())


def test_a_length_that_most_pieces_have_is_ranked_in_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 100)
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50 + 1).cast("long").alias("length"))
    packed = packing.pack(rows, 64).collect()
    assert len(packed) == 3000
    count = dict(Counter(r["length"] for r in packed))
    assert packing.least_bins(count, 64) <= whole(packed, 64) <= sum(t for t, _ in packing.best_fit(count, 64))


def fewest(items, capacity):
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
            place(i + 1, [r - items[i] * (j == k) for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - items[i]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


def test_bin_completion_finds_the_fewest_bins():
    draw, gained = random.Random(2), 0
    for _ in range(600):
        capacity = draw.choice([10, 20, 50, 100])
        items = [draw.randrange(1, capacity + 1) if draw.random() < .7 else draw.randrange(capacity // 5, capacity // 2) for _ in range(draw.randrange(12))]
        count = dict(Counter(items))
        found = packing.complete(count, capacity)
        held = Counter()
        for times, pattern in found:
            assert times > 0 and sum(s * m for s, m in pattern) <= capacity
            held.update({s: m * times for s, m in pattern})
        assert held == Counter(items)
        assert sum(t for t, _ in found) == fewest(items, capacity) >= packing.least_bins(count, capacity) * bool(items)
        gained += sum(t for t, _ in packing.best_fit(count, capacity)) > sum(t for t, _ in found)
    assert gained


@pytest.mark.parametrize("name", ["op11_spelling", "op12_periodic", "op13_packing"])
def test_queries_run_on_whole_tables(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0
