import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm import lm_mix
from tests.llm.cases import documents, rows


def teaches(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode()


def _units(raw):
    """Units of a text: words and the blank or end behind each."""
    out, now = [], b""
    for b in raw + b"\xff":
        now += bytes([b])
        if b in b" \t\n\x0b\x0c\r\xff":
            out.append(now)
            now = b""
    return out


def bits_of(code, unit):
    """(keys, bit) of a unit's bits: the slots of the first three predictors, and the unit so far with the node."""
    m64, odd = (1 << 64) - 1, 0x9E3779B97F4A7C15
    out = []
    for k, symbol in enumerate(unit):
        a, b, c = ([x + 1 for x in unit[:k][::-1][:3]] + [0, 0, 0])[:3]
        two = (a * 300 + b) & m64
        contexts = (a, two * odd & m64, (two * 300 + c + 7) * odd & m64)
        lo = int(code.starts[symbol])
        for node, bit in zip(code.nodes[lo:lo + code.sizes[symbol]].tolist(), code.bits[lo:lo + code.sizes[symbol]].tolist()):
            keys = []
            for i, x in enumerate(contexts):
                x = (x + (node + 1) * 0xD6E8FEB86659FD93) & m64
                x ^= x >> 29
                keys.append((i, (x * odd & m64) >> (64 - lm_mix.SLOT_BITS[i])))
            out.append(([*keys, (unit[:k], node)], bit))
    return out


class Mixer:
    """One text's weights and map, bit by bit."""

    def __init__(self):
        self.weights = [list(w) for w in lm_mix.WEIGHTS]
        self.map = [0.0] * lm_mix.CELLS
        self.cost, self.moves, self.shifts = 0.0, [], []

    def bit(self, x, gate, bit):
        if not bit:
            x = [-a for a in x]
        z = max(-lm_mix.FAR, min(lm_mix.FAR, sum(a * b for a, b in zip(self.weights[gate], x))))
        cell, sign = min(int(abs(z)), lm_mix.CELLS - 1), (z > 0) - (z < 0)
        chance = 1 / (1 + math.exp(-(z + sign * self.map[cell])))
        self.cost -= math.log2(chance)
        self.moves.append((gate, [lm_mix.RATE * a / (1 + math.exp(z)) for a in x]))
        self.shifts.append((cell, lm_mix.MAP_RATE * sign * (1 - chance)))

    def beat(self):
        for gate, move in self.moves:
            for i, a in enumerate(move):
                self.weights[gate][i] += a
        for cell, a in self.shifts:
            self.map[cell] += a
        self.moves, self.shifts = [], []


def brute(data):
    train = [_units(lower(r[1])) for r in data if teaches(r[0])]
    symbols = Counter(b for text in train for u in text for b in u)
    code = lm_mix.Code([symbols.get(s, 0) for s in range(256)])
    spelled = {u: bits_of(code, u) for r in data for u in _units(lower(r[1]))}
    counts = defaultdict(lambda: [0, 0])
    for text in train:
        for unit in text:
            for keys, bit in spelled[unit]:
                for key in keys:
                    counts[key][bit] += 1
    words = Counter(u[:-1] for text in train for u in text if len(u) > 1)
    n, v = sum(words.values()) + len(train), len(words) + (len(train) > 0)
    out = []
    for doc_id, text, *_ in data:
        raw = lower(text)
        own = [words[w] for w in raw.split()] + [len(train)]
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in own)
        mixer = Mixer()
        for i, unit in enumerate(_units(raw)):
            if i and i % lm_mix.BEAT == 0:
                mixer.beat()
            for keys, bit in spelled[unit]:
                seen = [counts.get(k, (0, 0)) for k in keys]
                x = [lm_mix.STEP * max(-lm_mix.MOST, min(lm_mix.MOST, round(math.log((b + 0.4) / (a + 0.4)) / lm_mix.STEP))) for a, b in seen]
                mixer.bit(x, sum(sum(seen[-1]) >= k for k in lm_mix.SEEN), bit)
        out.append((doc_id, not teaches(doc_id), len(own), sum(c > 0 for c in own), n, base, -mixer.cost * math.log10(2)))
    return out


def small():
    return [r for r in rows(n=25) if len(r[1] or "") < 3000] + [(500, "abc " * 700, "en", "s", 0)]


def compared(spark, data, **more):
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in lm_mix.score(documents(spark, data, **more)).collect()]
    key = lambda r: (repr(r[0]), r[2], round(r[5], 6), round(r[6], 3))
    for a, b in zip(sorted(got, key=key), sorted(brute(data), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], rel=2e-4)


def test_scores_match_brute_force(spark):
    compared(spark, small(), clash=("grp", "word", "n"))


def test_ranges_copies_and_pieces_change_nothing(spark, monkeypatch):
    """Many small ranges, whose ends share beginnings, several groups of each, several chunks, pieces and groups of lanes."""
    for name, value in (("RANGES", 40), ("CHUNK", 4000), ("PIECE", 500), ("ASKED_UNITS", 5), ("TOGETHER", 7), ("LANES", 3)):
        monkeypatch.setattr(lm_mix, name, value)
    compared(spark, small())


def test_what_two_ranges_share_is_counted_over_both():
    code = lm_mix.Code([1] * 256)
    found = [b"ab ", b"abc ", b"abd ", b"abd\xff", b"b ", b"bcd "]
    n = np.array([3, 1, 4, 1, 5, 9])

    def flat(some):
        return np.frombuffer(b"".join(some), np.uint8), np.array([len(x) for x in some], np.int64)

    none = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    asked = flat([*found, b"abx ", b"q "])
    want = lm_mix.Known(code, *flat(found), n, [], none).answer(*asked)
    for at in range(1, len(found)):
        ends = [found[at]]
        symbols, sizes = flat(found)
        context = lm_mix._contexts(symbols, sizes)
        hit = np.isin(context, lm_mix._beginnings(ends))
        shared = lm_mix._added_up(context[hit], symbols[hit], np.repeat(n, sizes)[hit])
        for part in (slice(None, at), slice(at, None)):
            known = lm_mix.Known(code, *flat(found[part]), n[part], ends, shared)
            own = flat(found[part])
            codes, bits, words = known.answer(*own)
            begin = np.concatenate(([0], np.cumsum(want[1])))[[part.start or 0, part.stop or len(found)]]
            assert codes.tolist() == want[0][begin[0]:begin[1]].tolist() and words.tolist() == want[2][part if part.stop else slice(at, len(found))].tolist()
    assert want[2].tolist() == [3, 1, 5, 5, 5, 9, 0, 0]


def _model():
    counts = np.random.default_rng(2).integers(0, 50, (int(lm_mix.TABLES[-1]), 2))
    return lm_mix.Model([1] * 256, lm_mix.steps_of(counts))


def _bits(model, texts):
    found, which, each = lm_mix.units(texts)
    symbols, sizes = np.frombuffer(b"".join(found), np.uint8), np.array([len(x) for x in found], np.int64)
    last = np.random.default_rng(3).integers(0, 254, int(model.code.sizes[symbols].sum())).astype(np.uint8)
    return model.bits(symbols, sizes, last, which, each), model.codes(symbols, sizes, last), (found, which, each)


@pytest.mark.parametrize("lanes", [1, 4, 256])
def test_weights_and_map_are_carried_through_a_text(monkeypatch, lanes):
    monkeypatch.setattr(lm_mix, "LANES", lanes)
    rng = np.random.default_rng(7)
    texts = [b" ".join(b"w%d" % i for i in rng.integers(0, 300, n)) for n in (5, 40, 700, 3000, 0, 900)]
    model = _model()
    got, codes, (found, which, each) = _bits(model, texts)
    n = [int(model.code.sizes[list(u)].sum()) for u in found]
    begin, at = np.cumsum(n) - n, 0
    for bits, size in zip(got, each.tolist()):
        mixer = Mixer()
        for i, unit in enumerate(which[at:at + size].tolist()):
            if i and i % lm_mix.BEAT == 0:
                mixer.beat()
            for row in codes[begin[unit]:begin[unit] + n[unit]].tolist():
                # codes hold the odds of the bit that comes
                mixer.bit([(byte // 2 - lm_mix.MOST) * lm_mix.STEP if byte != lm_mix.UNSEEN else 0.0 for byte in row], 1 + row[-1] % 2, 1)
        at += size
        assert bits == pytest.approx(mixer.cost, rel=2e-4)


def test_a_bit_and_its_opposite_have_chances_that_add_up_to_one():
    """Also where the sum is far out, with no floor."""
    for steps in (0, 1, 20, 63):
        costs = []
        for bit in (0, 1):
            byte = lm_mix.coded(np.array([steps]), np.array([bit]), np.array([1])).item()
            codes = np.full((1, 4), byte, np.uint8).view(np.uint32).ravel()
            costs.append(lm_mix.mixed(codes, np.array([0]), np.array([1]), np.array([0]), np.array([0]), np.array([1]))[0])
        assert sum(math.exp(-c) for c in costs) == pytest.approx(1.0, abs=1e-6)


def test_every_symbol_has_a_code_and_the_code_is_complete():
    code = lm_mix.Code([5 if s in b"ab \xff" else 0 for s in range(256)])
    assert sum(2.0 ** -float(s) for s in code.sizes) == pytest.approx(1.0)
    found, which, each = lm_mix.units([b"ab a", b"", b"AB  "])
    assert found == [b" ", b"ab ", b"a\xff", b"\xff"] and which.tolist() == [1, 2, 3, 1, 0, 3] and each.tolist() == [2, 1, 3]


def test_known_text_costs_less(spark):
    held = [i for i in range(1000) if not teaches(i)]
    fox = "the quick brown fox jumps over the lazy dog again and again"
    data = [(i, fox, "en", "s", 0) for i in range(40)] + [(held[-1], "zq xv kj wq pf", "en", "s", 0)]
    got = {r.doc_id: r for r in lm_mix.score(documents(spark, data)).collect()}
    assert got[0].score > got[0].base_score and got[0].bits_per_byte < 1 and got[held[-1]].bits_per_byte > 2


def test_empty_tables(spark):
    assert lm_mix.score(documents(spark, [])).count() == 0
    only = [i for i in range(100) if not teaches(i)][:2]
    got = lm_mix.score(documents(spark, [(i, "a b", "en", "s", 0) for i in only])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] == [(3, 0, 0, 0.0)] * 2
