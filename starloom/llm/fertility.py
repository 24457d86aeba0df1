"""Quality rules by tokeniser fertility.

Two public vocabularies measure every whole text: a SentencePiece model
with byte fallback and a byte-level one.  A text's characters per token,
the share of byte-fallback tokens and the entropy of its tokens must lie in
a band, chosen by language.  Text that is no prose of a language (symbol
salad, capitals, key material, one phrase over and over) takes more tokens
for its characters, or less varied ones.  A text without a language that has a
band takes the band of the script that most of its characters are of.

Words are encoded one by one, as they stand behind a blank, and what was
measured of a word is remembered, so that a frequent word costs a lookup.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starloom.llm.common import MEMO_BYTES, MEMO_ENTRY, bytes_of, held, number_of, numbered, pieces, small_batches

#: Characters that count as symbols. Fixed by the rule.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


@dataclass(frozen=True)
class Band:
    """What a text of a language may measure.

    ``least_bits``: least entropy of a text's tokens by their number, as
    (log2 of the number, bits); between the points in proportion, outside
    as at the ends.  A longer text of a language shows more of its tokens.
    """

    piece_low: float
    byte_low: float
    least_bits: tuple[tuple[float, float], ...]
    piece_high: float = 12.0
    fallback: float = 0.2


#: Bands by language; others and texts without a language take their script's, and else ``OTHER``. Texts of fewer tokens than ``LEAST_TOKENS`` are too short to judge (a parameter of ``annotate``).
ROMANCE = ((5, 4.0), (6, 4.65), (7, 5.25), (8, 5.68), (9, 5.98), (10, 6.18), (11, 6.35), (12, 6.48), (14, 6.55))
BANDS = {
    "en": Band(1.5, 1.5, ((5, 4.0), (6, 4.7), (7, 5.35), (8, 5.8), (9, 6.15), (10, 6.38), (11, 6.55), (12, 6.7), (14, 6.8))),
    "de": Band(1.4, 1.3, ROMANCE), "fr": Band(1.3, 1.3, ROMANCE), "es": Band(1.3, 1.3, ROMANCE),
}
OTHER = Band(1.0, 1.0, ((5, 3.5), (7, 4.5), (9, 5.0), (14, 5.0)))
LEAST_TOKENS = 32
#: Bands by script. Both vocabularies spell most of them letter by letter or byte by byte, so bounds lie where clean prose does, not where Latin's do.
#: ``rest`` are scripts that the vocabularies hold next to nothing of; ``marked`` is Latin with many marked letters, as Vietnamese.
SCRIPT_BANDS = {
    "cyrillic": Band(1.5, 0.66, ((5, 3.5), (7, 5.0), (9, 5.2)), fallback=0.1),
    "greek": Band(0.72, 0.66, ((5, 3.0), (7, 3.7), (9, 4.2)), fallback=0.1),
    "arabic": Band(0.78, 0.7, ((5, 3.0), (7, 3.9), (9, 4.3)), fallback=0.1),
    "hebrew": Band(0.72, 0.62, ((5, 3.0), (7, 3.5), (9, 3.9)), fallback=0.1),
    "devanagari": Band(0.6, 0.44, ((5, 3.0), (7, 3.9), (9, 4.4))),
    "thai": Band(0.68, 0.38, ((5, 3.0), (7, 4.0), (9, 4.5))),
    "hangul": Band(0.5, 0.28, ((5, 3.5), (7, 4.4), (9, 4.8)), fallback=0.45),
    "kana": Band(0.45, 0.4, ((5, 3.0), (7, 3.9), (9, 4.3)), fallback=0.35),
    "han": Band(0.4, 0.3, ((5, 3.0), (7, 3.7), (9, 4.1)), fallback=0.35),
    "rest": Band(0.25, 0.2, ((5, 2.5), (9, 3.0)), fallback=1.0),
    "marked": Band(0.95, 0.66, ((5, 3.5), (7, 4.6), (9, 5.0)), fallback=0.1),
}
#: First code points of ranges and their scripts; "" is what no script's band is for (plain Latin, digits, signs).
RANGES = ((0, ""), (0xC0, "marked"), (0x250, ""), (0x300, "marked"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "rest"), (0x590, "hebrew"),
          (0x600, "arabic"), (0x700, "rest"), (0x750, "arabic"), (0x780, "rest"), (0x8A0, "arabic"), (0x900, "devanagari"), (0x980, "rest"),
          (0xE00, "thai"), (0xE80, "rest"), (0x1100, "hangul"), (0x1200, "rest"), (0x1C80, "cyrillic"), (0x1C90, "rest"), (0x1D00, ""),
          (0x1E00, "marked"), (0x1F00, "greek"), (0x2000, ""), (0x2DE0, "cyrillic"), (0x2E00, ""), (0x3040, "kana"), (0x3100, "han"),
          (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, ""), (0x3400, "han"), (0x4DC0, ""), (0x4E00, "han"), (0xA000, "rest"),
          (0xA640, "cyrillic"), (0xA6A0, "rest"), (0xA700, ""), (0xA800, "rest"), (0xA8E0, "devanagari"), (0xA900, "rest"), (0xAC00, "hangul"),
          (0xD800, ""), (0xF900, "han"), (0xFB00, ""), (0xFB13, "rest"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, ""), (0xFE70, "arabic"),
          (0xFEFF, ""), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, ""), (0x10000, "rest"), (0x1D000, ""), (0x1E000, "rest"), (0x1F000, ""),
          (0x20000, "han"), (0x40000, ""))
SCRIPTS = ("", *SCRIPT_BANDS)
FIRSTS = np.array([first for first, _ in RANGES], np.uint32)
OWNERS = np.array([SCRIPTS.index(name) for _, name in RANGES])
MARKED_SHARE = 0.2

STATE = T.StructType([
    *(T.StructField(f"__q_{n}", T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "tokens", "fallback", "byte_tokens")),
    T.StructField("__q_entropy", T.DoubleType()), T.StructField("__q_base_failed", T.BooleanType()), T.StructField("__q_kept", T.BooleanType())])


class Words:
    """What the vocabularies make of each word; words are numbered as they come."""

    def __init__(self, piece_model: bytes, ranks: bytes):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines())}
        self.bytes = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.kind = np.uint16 if self.pieces.vocab_size() <= 1 << 16 else np.uint32
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids: list[bytes] = []
        self.facts = np.zeros((4, 1024), np.int64)  # characters, tokens, fallback tokens, byte-level tokens
        self.hashes = np.zeros(1024, np.uint64)
        self.size = 0

    def learn(self, words: list[bytes]) -> None:
        first, n = len(self.ids), len(self.ids) + len(words)
        while self.facts.shape[1] < n:
            self.facts = np.concatenate((self.facts, np.zeros_like(self.facts)), axis=1)
            self.hashes = np.concatenate((self.hashes, np.zeros_like(self.hashes)))
        text = [w.decode("utf-8", "replace") for w in words]
        for i, (w, t, ids) in enumerate(zip(words, text, self.pieces.encode(text, num_threads=1)), first):
            own = np.array(ids, self.kind)
            self.number[w] = i
            self.ids.append(own.tobytes())
            self.facts[:, i] = len(t), len(ids), self.fallback[own].sum(), len(self.bytes.encode_ordinary(" " + t))
            self.hashes[i] = xxhash.xxh64_intdigest(w)
            self.size += len(w) + own.nbytes + MEMO_ENTRY


def repeated_words(hashes: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that stand twice or more in the text (compared by 64-bit hashes)."""
    n = len(hashes) - window + 1
    if n < 2:
        return 0
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + n]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    marks = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(np.isin(rolled, twice))
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    return int((np.cumsum(marks) > 0).sum())


def measure(raw: bytes, known: Words) -> tuple:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, tokens, fallback, byte_tokens, entropy``."""
    words = raw.split()
    numbers = np.array([known.number[w] for w in words], np.int64)
    chars, tokens, fallback, byte_tokens = known.facts[:, numbers].sum(axis=1).tolist()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ids = np.frombuffer(b"".join([known.ids[i] for i in numbers.tolist()]), known.kind)
    counts = np.unique(ids, return_counts=True)[1]
    entropy = float(np.log2(len(ids)) - (counts * np.log2(counts)).sum() / len(ids)) if len(ids) else 0.0
    return (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(known.hashes[numbers]), tokens, fallback, byte_tokens, max(entropy, 0.0))


def in_band(band: Band, word_chars: int, tokens: int, fallback: int, byte_tokens: int, entropy: float, least_tokens: int = LEAST_TOKENS) -> bool:
    if tokens < least_tokens:
        return True
    least = np.interp(np.log2(tokens), *zip(*band.least_bits))
    return bool(band.piece_low * tokens <= word_chars <= band.piece_high * tokens and band.byte_low * byte_tokens <= word_chars
                and fallback <= band.fallback * tokens and entropy >= least)


def script(raw: bytes) -> str:
    """The script that most of a text's characters are of (blanks aside; the first of equal ones), or ""; ``marked`` needs a fifth of the Latin text's."""
    points = np.frombuffer(b"".join(raw.split()).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    counts = np.bincount(OWNERS[np.searchsorted(FIRSTS, points, side="right") - 1], minlength=len(SCRIPTS))
    marked = counts[-1]
    counts[0] += marked
    counts[-1] = 0
    most = SCRIPTS[int(counts.argmax())]
    return "marked" if not most and marked and marked >= MARKED_SHARE * counts[0] else most


def _words(piece_model, ranks) -> Words:
    return held(("fertility", piece_model, ranks), lambda: Words(piece_model.value, ranks.value))


def annotate(docs: DataFrame, piece_model_file: str, ranks_file: str, text: str = "text", lang: str = "lang",
             bands: dict[str, Band] | None = None, other: Band = OTHER, scripts: dict[str, Band] | None = None,
             least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """``docs`` with the columns of ``STATE``.

    ``base_failed``: fewer than 20 words, or over 30 in a hundred words
    stand in repeated windows of 8.  ``kept``: not so, and in the
    language's band, or where ``bands`` has none in that of the text's
    script, or in ``other``; a text of fewer than ``least_tokens`` piece
    tokens is too short for a band and kept if the base rules keep it.  Null and empty texts have no words and fail.  Repeated
    rows are judged each; columns of ``docs`` named as those added give way.
    """
    spark = docs.sparkSession
    docs = docs.drop(*STATE.names)
    small_batches(spark)
    bands = BANDS if bands is None else bands
    scripts = SCRIPT_BANDS if scripts is None else scripts
    shared = []
    for name in (piece_model_file, ranks_file):
        with open(name, "rb") as f:
            shared.append(spark.sparkContext.broadcast(f.read()))
    at, at_lang = docs.columns.index(text), docs.columns.index(lang)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _words(*shared)
        for batch in batches:
            for part in pieces([batch], text):
                raw = bytes_of(part.column(at).cast(pa.binary()))
                if known.size > MEMO_BYTES:
                    known.clear()
                new = {w for x in raw for w in x.split() if w not in known.number}
                known.learn(list(new))
                rows = []
                for x, language in zip(raw, part.column(at_lang).to_pylist()):
                    m = measure(x, known)
                    failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
                    band = None if failed else bands.get(language) or scripts.get(script(x), other)
                    rows.append((*m, failed, band is not None and in_band(band, m[1], *m[5:], least_tokens)))
                columns = list(zip(*rows)) if rows else [()] * len(STATE.fields)
                kinds = [pa.int64()] * 8 + [pa.float64(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                                 [*part.schema.names, *STATE.names])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *STATE.fields]))


def keep(docs: DataFrame, piece_model_file: str, ranks_file: str, text: str = "text", lang: str = "lang", **more) -> DataFrame:
    """The rows of ``docs`` that the rules keep, repeated ones each, with all their columns whatever their names."""
    own = numbered(docs)
    kept = annotate(own, piece_model_file, ranks_file, number_of(docs, text), number_of(docs, lang), **more).filter("__q_kept")
    return kept.select(*own.columns).toDF(*docs.columns)
