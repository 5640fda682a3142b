"""Sizes far beyond the test tables, without Spark."""

import random
import time

import numpy as np
import public_tokenizers
import pytest

from lakeloom.llm import bpe, context_coder, exact_dedup, token_output


def test_directory_of_a_million_ranges():
    loads = dict.fromkeys(range(1 << 20), 100)
    began = time.perf_counter()
    d = exact_dedup.build_directory(loads, 20, 100)
    slots = d.slots
    assert time.perf_counter() - began < 10 and len(d.local) == len(slots) == 1 << 20


def test_directory_splits_only_what_is_overfull():
    rng = random.Random(4)
    loads = {p: rng.choice([1, 1, 1, 40, 500]) for p in rng.sample(range(1 << 10), 300)}
    d = exact_dedup.build_directory(loads, 10, 100)
    held = np.zeros(len(d.local), np.int64)
    for p, n in loads.items():
        held[d.of(p << 54)] += n
    slots = d.slots
    assert len(slots) == 1 << d.depth and (np.diff(slots) >= 0).all()
    for b, depth in enumerate(d.local):
        assert held[b] <= 100 or depth == 10
        assert (slots == b).sum() == 1 << (d.depth - depth)
    # no two halves of a split would fit into one bucket
    starts = {(s >> (d.depth - k), k): b for b, (s, k) in enumerate(zip(d.starts, d.local))}
    for (prefix, k), b in starts.items():
        other = starts.get((prefix ^ 1, k))
        assert k == 0 or other is None or held[b] + held[other] > 100
    for key in (0, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(200))):
        assert d.of(key) == slots[key >> (64 - d.depth)]


def test_one_bucket_if_nothing_is_overfull():
    d = exact_dedup.build_directory({}, 10, 100)
    assert (d.depth, list(d.slots), d.of(123 << 40)) == (0, [0], 0)


def test_ids_that_do_not_fit_the_rank_map_are_refused():
    with pytest.raises(ValueError, match="rank map"):
        bpe.pair_rows({b"a": 0, b"b": 1 << 20})
    wide = {b"a": 0, b"b": (1 << 20) - 2, b"ab": (1 << 20) - 1}
    moves, slots = bpe.displaced(bpe.pair_rows(wide))
    h = bpe.pair_hash(0, wide[b"b"])
    got = int(slots[(h >> 32 ^ int(moves[h & len(moves) - 1])) & len(slots) - 1]) ^ (0 * bpe.NO_MERGE + wide[b"b"]) * bpe.NO_MERGE
    assert got == wide[b"ab"]


def _coded(codes, words):
    buf, bounds = np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)])
    return codes.of(buf, bounds.astype(np.int64)).tolist()


def test_piece_codes_hold_no_object_per_piece(monkeypatch):
    monkeypatch.setattr(bpe, "TASK_WORDS", 300)
    rng = random.Random(5)
    words = list(dict.fromkeys(bytes(rng.choices(range(256), k=rng.choice([1, 2, 7, 8, 9, 15, 16, 40]))) for _ in range(4000)))
    known, new = words[:1000], words[1000:]
    codes = bpe.PieceCodes(b"".join(known), np.array(list(map(len, known))), np.arange(1000) * 2, 2000)
    want, seen = {w: 2 * i for i, w in enumerate(known)}, 2000
    for at in range(0, len(new), 700):  # the table grows
        batch = rng.choices(known + new[:at + 700], k=5000)
        for w in batch:
            want.setdefault(w, 2000 + len(want) - 1000)
        assert _coded(codes, batch) == [want[w] for w in batch]
        assert codes.taken() == [w for w, c in want.items() if c >= seen]
        seen = 2000 + len(want) - 1000
    assert max(map(len, codes.long)) == 40 and min(map(len, codes.long)) == 16
    assert codes.full() and _coded(codes, known) == list(range(0, 2000, 2)) and not codes.taken()
    assert _coded(codes, [new[5], new[3], new[5]]) == [2000, 2001, 2000] and codes.taken() == [new[5], new[3]] and not codes.full()


def test_ids_of_pieces_are_kept_in_place():
    pieces = bpe.Pieces(np.array([7, 8, 9], np.uint32), np.array([1, 2]))
    for n in range(50):
        pieces.add(np.array([n, n + 1, n], np.uint32), np.array([0, 1, 2]), n == 25)
        base = 2 + 3 * (n % 25)
        ids, upto = pieces.spelt(np.array([1, base + 1, base, base + 2, 0]))
        assert ids.tolist() == [8, 9, n, n + 1, n, 7] and upto.tolist() == [2, 3, 3, 5, 6]


class Counting:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, own):
        self.own, self.texts = own, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.own.encode_batch_fast(texts, **options)


def test_library_gets_many_pieces_in_a_text():
    own, rng = token_output.load(public_tokenizers.path("byte_bpe_50k.json")), random.Random(6)
    tokenizer, sizes, added = Counting(own), token_output.token_sizes(own), ["<|endoftext|>"]
    words = [f"{rng.choice(['', ' '])}{''.join(rng.choices('abcdefghij', k=9))}".encode() for _ in range(5000)]
    odd = [b"<|", b"endoftext", b"|>", b" ", b"  ", b"\n\n", "\u3000".encode(), b"'s", b"s", b"12", b" 3", " \u6f22\u5b57".encode()]
    for pieces in (words, odd, words + odd, odd[3:] + words, []):
        tokenizer.texts = 0
        ids, n = token_output._encoded(tokenizer, pieces, "<u2", sizes, added)
        want = [e.ids for e in own.encode_batch_fast([w.decode() for w in pieces], add_special_tokens=False)]
        assert ids.tolist() == [i for e in want for i in e] and n.tolist() == list(map(len, want))
        if pieces is words:
            assert tokenizer.texts == 3


class Splitting(Counting):
    """Also one whose pre-tokenizer can be set."""

    pre_tokenizer = property(lambda self: self.own.pre_tokenizer, lambda self, p: setattr(self.own, "pre_tokenizer", p))


def test_library_splits_pieces_at_a_separator():
    own, plain = (token_output.load(public_tokenizers.path("byte_bpe_50k.json")) for _ in range(2))
    tokenizer, sizes, added = Splitting(own), token_output.token_sizes(own), ["<|endoftext|>"]
    odd = [b"<|", b"endoftext", b"|>", b" ", b"  ", b"\n\n", "\u3000".encode(), b"'s", b"s", b"!!", b"12", b" 3", " \u6f22\u5b57".encode(), b"e", "\u0301".encode()]
    clash = [*odd, " !\U0010fffe!".encode()]
    for pieces, texts in ((odd, 1), (odd[:1], 1), (clash, None), ([*odd, b"<|endoftext|>"], None)):
        tokenizer.texts = 0
        ids, n = token_output._encoded(tokenizer, pieces, "<u2", sizes, added)
        want = [e.ids for e in plain.encode_batch_fast([w.decode() for w in pieces], add_special_tokens=False)]
        assert ids.tolist() == [i for e in want for i in e] and n.tolist() == list(map(len, want))
        assert texts is None or tokenizer.texts == texts
    assert own.to_str() == plain.to_str()  # as it was


def test_pieces_reach_the_library_in_the_characters_of_its_vocabulary():
    own, plain = (token_output.load(public_tokenizers.path("byte_bpe_50k.json")) for _ in range(2))
    tokenizer, sizes, added = Splitting(own), token_output.token_sizes(own), ["<|endoftext|>"]
    every = [chr(c).encode() for c in (*range(1, 0x250), 0x2028, 0xFFFD, 0x10FFFE, 0x10FFFF)]  # a separator of older code too
    for pieces, texts in ((every[-4:], 1), ([b"x"] * 251, 2), (every, -(-len(every) // token_output.TEXT_PIECES))):
        tokenizer.texts = 0
        ids, n = token_output._encoded(tokenizer, pieces, "<u2", sizes, added)
        want = [e.ids for e in plain.encode_batch_fast([w.decode() for w in pieces], add_special_tokens=False)]
        assert ids.tolist() == [i for e in want for i in e] and n.tolist() == list(map(len, want))
        assert tokenizer.texts == texts


def test_a_worker_keeps_its_tokenizer_for_its_next_tasks():
    definition = token_output.load(public_tokenizers.path("byte_bpe_50k.json")).to_str()
    held = [b"ab", np.array([1, 1]), np.array([64, 65], "<u2"), np.array([1, 1]), None]
    first = token_output._encoder(held, definition)
    assert held[-1] is None and token_output._encoder(held, definition)[0] is not first[0]  # a task that was cut off leaves nothing
    held[-1] = first
    assert token_output._encoder(held, definition) is first and held[-1] is None


def test_order_0_is_the_same_by_counting_and_by_sorting():
    ids = np.random.default_rng(2).integers(0, 50, 1000)
    few = context_coder.frequencies(ids)
    many = context_coder.frequencies(np.where(ids == 49, 1 << 20, ids))
    assert few[0][:-1].tolist() == many[0][:-1].tolist() and few[1].tolist() == many[1].tolist() and many[0][-1] == 1 << 20
