"""The byte scans, encoders and small algorithms, without Spark."""

import json
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestar.llm import bytescan as B
from lodestar.llm import decontaminate, embedding_dedup, encoding, exchange, packing, quality, records, substring_dedup, token_counts
from lodestar.llm.catalog import tokenizer_file

TEXTS = ["", " ", "a", "a  b", " a b ", "x\ny\n\nz\n w", "foo's 'bar' I'LL", "é. ÉÀß ÿ a×b ÷", "a\u00a0b \u2003c", "A\u0301b \u0301c", "<|endoftext|> x<|endoftext|>y", "Σ ΑΣ.",
         "中文 字. 🙂 a.🙂", "12 3,4 a1b2", "tab\there\r\nand\x0bthere", "q" * 700 + " r", "!!! ... a!!b", None, "end\n"]


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_are_those_of_a_regex_for_any_slices(size):
    for pattern, table in ((rb"[^\x20\x09-\x0D]+", B.NOT_SPACE), (rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", B.ALNUM)):
        got = []
        for lo, hi, data, offsets in B.text_slices(pa.array(TEXTS), size):
            starts, ends, first = B.find_words(data, offsets, table)
            got += [[bytes(data[a:b]) for a, b in zip(starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]])] for i in range(hi - lo)]
        assert got == [re.findall(pattern, (t or "").encode()) for t in TEXTS]


def test_hashes_follow_content_not_place():
    rng = random.Random(1)
    words = ["".join(rng.choices("ab", k=rng.randint(1, 12))) for _ in range(3000)]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = B.find_words(data, np.array([0, len(data)]), B.NOT_SPACE)
    h = B.hash_spans(data, starts, ends)
    assert len(set(h.tolist())) == len(set(words)) and len({(w, x) for w, x in zip(words, h.tolist())}) == len(set(words))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_encode_as_whole_texts(name, monkeypatch):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(tokenizer_file(name))
    whole.encode_special_tokens = True
    rng = random.Random(2)
    pool = [c for t in TEXTS if t for c in t] + [" ", "\n", "é", "X", ".", "'s", "\t", "9"]
    texts = TEXTS + ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(1500)]
    monkeypatch.setattr(encoding, "CACHE_CHUNKS", 700)  # the memory starts anew now and then
    for _ in range(2):
        e = encoding.ChunkEncoder(tokenizer_file(name))
        ids, counts = e.encode(pa.array(texts))
        off = np.concatenate([[0], np.cumsum(counts)])
        for i, t in enumerate(texts):
            assert ids[off[i]:off[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_a_tokenizer_of_another_make_is_not_cut(tmp_path):
    made = json.load(open(tokenizer_file("byte_bpe_50k.json")))
    made["pre_tokenizer"]["use_regex"] = False
    (tmp_path / "t.json").write_text(json.dumps(made))
    e = encoding.ChunkEncoder(str(tmp_path / "t.json"))
    ids, counts = e.encode(pa.array(["a b. c", "", "a b. c"]))
    assert e.kind == "other" and counts.tolist() == [len(e.tokenizer.encode("a b. c").ids), 0, len(ids) // 2]


def test_token_counts_follow_the_unigram_library():
    from tokenizers import Tokenizer, models, pre_tokenizers
    rng = random.Random(3)
    pieces = sorted({"".join(rng.choices("ab\u2581", k=rng.randint(1, 4))) for _ in range(60)} - {"b"})
    scores = [-float(rng.randint(1, 3)) for _ in pieces]  # many ties
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *zip(pieces, scores)], unk_id=0, byte_fallback=False))
    lib.pre_tokenizer = pre_tokenizers.Metaspace(replacement="\u2581", prepend_scheme="always", split=True)
    lib2 = Tokenizer(models.Unigram([*zip(pieces, scores), ("<unk>", max(scores))], unk_id=len(pieces), byte_fallback=False))
    lib2.pre_tokenizer = lib.pre_tokenizer
    texts = ["", "a", " a", "a  b", "abab ba", "ccc", "acca", "b", None] + ["".join(rng.choices("abc \u2581", k=rng.randint(1, 40))) for _ in range(800)]
    counts, values = token_counts.WordCounter(pieces, scores).count(pa.array(texts))
    assert counts.tolist() == [len(lib2.encode(t or "").ids) for t in texts]
    assert values[0] == 0 and (values <= 0).all()


def test_minimum_slack_fills_best_and_loses_nothing():
    rng = random.Random(4)
    for _ in range(60):
        cap = rng.randint(5, 40)
        counts = {n: rng.randint(1, 3) for n in rng.sample(range(1, cap + 1), min(cap, 6))}
        used = packing.best_filling(cap, counts)
        sums = {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= cap}
        assert sum(n * k for n, k in used.items()) == max(sums) and all(k <= counts[n] for n, k in used.items())
        lengths = [rng.randint(1, cap) for _ in range(80)]
        windows = packing.minimum_slack(lengths, cap)
        assert sorted(i for w in windows for i in w) == list(range(80))
        assert max(sum(lengths[i] for i in w) for w in windows) <= cap
    assert packing.minimum_slack([], 8) == []


def test_wu_manber_finds_what_a_plain_search_finds():
    rng = random.Random(5)
    word = lambda: rng.choice("abcd")
    items = [" ".join(word() for _ in range(rng.randint(0, 14))) for _ in range(12)] + [None, "a", "a"]
    docs = [" ".join(word() for _ in range(rng.randint(0, 200))).upper() for _ in range(30)] + ["", None]
    size = 6
    vocabulary, patterns, names = decontaminate.prepare(items, [str(i % 13) for i in range(len(items))], size)
    n_words, spans, found = decontaminate._search_batch(pa.array(docs), vocabulary, patterns, names)
    for d, n, s, ids in zip(docs, n_words.to_pylist(), spans.to_pylist(), found.to_pylist()):
        w, hit, expect = (d or "").lower().split(), set(), set()
        for k, item in enumerate(items):
            p = (item or "").split()
            m = min(size, len(p))
            for a in range(len(p) - m + 1 if m else 0):
                for i in range(len(w) - m + 1):
                    if w[i:i + m] == p[a:a + m]:
                        hit |= set(range(i, i + m))
                        expect.add(str(k % 13))
        assert n == len(w) and {i for x in s for i in range(x["start"], x["end"])} == hit and set(ids) == expect and len(ids) == len(expect)


def test_suffix_automaton_counts_places():
    rng = random.Random(6)
    for size in (1, 3, 5):
        seqs = [[rng.randint(0, 2) for _ in range(rng.randint(0, 25))] for _ in range(8)]
        places = [rng.randint(1, 2) for _ in seqs]
        count: dict = {}
        for s, n in zip(seqs, places):
            for i in range(len(s) - size + 1):
                count[tuple(s[i:i + size])] = count.get(tuple(s[i:i + size]), 0) + n
        got = substring_dedup.repeated_windows(seqs, places, size)
        assert [g.tolist() for g in got] == [[i for i in range(len(s) - size + 1) if count[tuple(s[i:i + size])] > 1] for s in seqs]


def test_frames_come_back_and_damage_shows():
    data = b"".join(records.frame(p) for p in (b"", b"abc", bytes(range(256))))
    at, got = 0, []
    while at < len(data):
        payload, at = records.read_frame(memoryview(data), at)
        got.append(bytes(payload))
    assert got == [b"", b"abc", bytes(range(256))]
    for i in range(len(data)):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            at = 0
            while at < len(data):
                _, at = records.read_frame(memoryview(bytes(broken)), at)
    with pytest.raises(ValueError):
        records.read_frame(memoryview(data[:10]), 0)


def test_packed_pairs_come_back():
    rng = np.random.default_rng(7)
    keys = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    keys[:100] = keys[0]
    numbers = np.arange(500) % 400
    for hot in (50, 1000):
        t = pa.Table.from_batches([exchange.pack(9, keys, numbers, numbers.astype("<u4"), b"docs", 4, hot=hot)])
        k, n, _, x = exchange.unpack(t, "<u4")
        real = n != exchange.MARK
        assert sorted(zip(k[real].tolist(), n[real].tolist())) == sorted(zip(keys.tolist(), numbers.tolist()))
        assert (~real).sum() == (1 if hot == 50 else 0) and t["docs"].to_pylist().count(b"docs") == 1


def test_passages_do_not_depend_on_neighbours():
    texts = [t for t in TEXTS if t] + ["word " * 300, "A B C! " * 50]
    alone = [quality.passages(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in texts]
    (_, _, data, offsets), = B.text_slices(pa.array(texts))
    x, bounds = quality.passages(data, offsets)
    assert all(np.allclose(x[bounds[i]:bounds[i + 1]], a, atol=1e-5) for i, a in enumerate(alone)) and np.isfinite(x).all()


def test_rotation_keeps_lengths_and_balances_bits():
    x = np.random.default_rng(8).standard_normal((500, 16)) * np.linspace(3, 1, 16)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean, r = embedding_dedup.learn_rotation(x)
    assert np.allclose(r.T @ r, np.eye(16), atol=1e-8)
    share = ((x - mean) @ r > 0).mean(0)
    assert (share > 0.3).all() and (share < 0.7).all()
