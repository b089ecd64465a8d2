"""Exact token counts of every prefix of a text under a byte-level BPE vocabulary with word ends.

Prefix dynamic programming.  A sequence of tokens is the encoding of its string just when every two neighbours are
the encoding of theirs, so the encoding of a prefix is that of a shorter prefix plus one last token, which is the only
one that may follow it.  For every prefix of a word the table keeps its token count and last token; the next prefix
tries the tokens that end there.  A word that ends the text bears the end mark, which is one more lookup.

Texts are cut at ASCII white space and each distinct piece is normalised and split into words by the library itself;
then its words' counts are added up.  The table has one step per character of the normalised text (pieces joined by
one blank): the sum of the first k steps is the token count of the first k characters.  So cutting a text to a token
budget, or counting any prefix of it, reads the steps and never encodes again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, pack, ship

#: Words, pieces and pairs of tokens that a Python worker remembers, at most twice as many: a full table is kept as the
#: old one, from which what is still asked for moves on, and a new one begins.
WORDS, PIECES, PAIRS = 300_000, 100_000, 300_000

#: Pieces of these letters, then of these marks, are already normalised but for case, and are two words at most.  The
#: library itself normalises and splits all others.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)([!-&(-/:-@\[-`{-~]*)")

_COUNTERS: dict[str, PrefixCounter] = {}


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Memory:
    """What was asked for lately, in two tables of bounded size."""

    def __init__(self, most: Callable[[], int]):
        self.new, self.old, self.most = {}, {}, most

    def get(self, key: str) -> bytes | np.ndarray | None:
        if (known := self.new.get(key)) is None and (known := self.old.get(key)) is not None:
            self.put(key, known)
        return known

    def put(self, key: str, value: bytes | np.ndarray) -> None:
        if len(self.new) >= self.most():
            self.new, self.old = {}, self.new
        self.new[key] = value


class PrefixCounter:
    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.library, vocabulary = Tokenizer.from_file(path), model["vocab"]
        self.ranks = {pair: k for k, pair in enumerate(pairs)}
        self.parts = {left + right: (left, right) for left, right in reversed(self.ranks)}
        self.end = model.get("end_of_word_suffix") or ""
        mark = len(self.end)
        ending = {t[:len(t) - mark] for t in vocabulary if t.endswith(self.end) and t != self.end}
        inside = {t for t in vocabulary if not mark or not t.endswith(self.end) or t == self.end}
        self.matcher = ahocorasick.Automaton()
        for t in ending | inside:
            self.matcher.add_word(t, (len(t), t, t in inside, t in ending))
        self.matcher.make_automaton()
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.symbol = _byte_symbols()
        self.words = Memory(lambda: WORDS)
        self.pieces = Memory(lambda: PIECES)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.sides: tuple[dict, dict] = ({}, {})

    def _symbols(self, token: str) -> list[str]:
        if self.end and token.endswith(self.end) and len(token) > len(self.end):
            body = token[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _is_own_encoding(self, token: str) -> bool:
        symbols = self._symbols(token)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, 1 << 60), i) for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == 1 << 60:
                return False
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return True

    def _side(self, token: str, right: int) -> list[tuple[str, int]]:
        """The parts that stand at the token's left or right end while it is built, from the whole down, each with the
        rank of the merge that takes it in."""
        if (known := self.sides[right].get(token)) is None:
            known, taken = [(token, 1 << 60)] if self._is_own_encoding(token) else [], 1 << 60
            part = token
            while known and (two := self.parts.get(part)):
                taken, part = self.ranks[two], two[right]
                known.append((part, taken))
            self.sides[right][token] = known
        return known

    def _follows(self, before: str, token: str) -> bool:
        """Whether these two tokens, or the one if ``before`` is empty, are the encoding of their string: no merge
        joins an end part of the one and a starting part of the other while both stand there."""
        key = (before, token)
        if (known := self.pairs.get(key)) is None:
            starts, ranks = self._side(token, 0), self.ranks
            known = bool(starts) and not before or bool(starts) and not any(
                (rank := ranks.get((a, b))) is not None and rank < taken_a and rank <= taken_b
                and rank > ranks.get(self.parts.get(a), -1) and rank > ranks.get(self.parts.get(b), -1)
                for a, taken_a in self._side(before, 1) for b, taken_b in starts)
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _prefixes(self, word: str) -> list[int]:
        """Token counts of the prefixes of 1, 2, ... characters, each as a word of its own."""
        symbols, ends = [], set()
        for c in word:
            symbols += [self.symbol[b] for b in c.encode()]
            ends.add(len(symbols))
        text, end, pairs, size = "".join(symbols), self.end, self.pairs, len(symbols)
        last, inner, counts = [""] * (size + 1), [0] * (size + 1), {}
        # every vocabulary entry that ends somewhere in the word, by its last symbol's place
        for at, (n, t, inside, ending) in self.matcher.iter(text):
            i = at + 1
            j = i - n
            before = last[j]
            if inside and not last[i] and ((ok := pairs.get((before, t))) or ok is None and self._follows(before, t)):
                last[i], inner[i] = t, inner[j] + 1
            if ending and i in ends and i not in counts and (
                    (ok := pairs.get((before, t + end))) or ok is None and self._follows(before, t + end)):
                counts[i] = inner[j] + 1
        return [counts[i] for i in sorted(ends)]

    def word(self, word: str) -> bytes | np.ndarray:
        """Differences of the token counts of a word's prefixes."""
        if (known := self.words.get(word)) is None:
            if word[0] == "'" and word[1:2].isalpha():  # 's, 're, ...: cut short they are two words
                counts = [*self._prefixes("'"), *(1 + n for n in self._prefixes(word[1:-1])), self._prefixes(word)[-1]]
            else:
                counts = self._prefixes(word)
            known = _differences(counts)
            self.words.put(word, known)
        return known

    def _any(self, text: str) -> bytes | np.ndarray:
        """Steps of any text without special strings, over its normalised characters."""
        text = self.library.normalizer.normalize_str(text)
        out, done = [], 0
        for symbols, (start, _) in self.library.pre_tokenizer.pre_tokenize_str(text):
            if start > done:
                out.append(bytes(start - done))  # the library drops these
            size, done = len(symbols), start
            while size > 0:
                size -= len(text[done].encode())
                done += 1
            out.append(self.word(text[start:done]))
        return _concatenated([*out, bytes(len(text) - done)])

    def piece(self, piece: str) -> bytes | np.ndarray:
        """Steps of a piece without white space.  A special string is one token where it is whole, ordinary text where
        a prefix cuts it."""
        out = []
        while True:
            at, special = min(((p, s) for s in self.special if (p := piece.find(s)) >= 0), default=(-1, ""))
            if at < 0:
                return _concatenated([*out, self._any(piece)])
            head, both = (np.frombuffer(x, np.int8).astype(np.int32) if isinstance(x, bytes) else x.copy() for x in (
                self._any(piece[:at]), self._any(piece[:at + len(special)])))
            if len(both):
                both[-1] = head.sum() + 1 - both[:-1].sum()
            out.append(_packed(both))
            piece = piece[at + len(special):]

    def steps(self, piece: str) -> bytes | np.ndarray:
        """Steps of a piece and of the blank after it, as bytes where each step fits into one."""
        if (known := self.pieces.get(piece)) is None:
            if (m := PLAIN.fullmatch(piece)) and "<|" not in piece:
                letters, marks = m.groups()
                known = _concatenated([*([self.word(letters.lower())] if letters else ()), *([self.word(marks)] if marks else ()), b"\0"])
            else:
                known = _concatenated([self.piece(piece), b"\0"])
            self.pieces.put(piece, known)
        return known


def _differences(counts: list[int]) -> bytes | np.ndarray:
    steps = [b - a for a, b in zip([0, *counts], counts, strict=False)]
    if all(-128 <= x < 128 for x in steps):
        return bytes(x & 255 for x in steps)
    return np.array(steps, np.int32)


def _packed(steps: np.ndarray) -> bytes | np.ndarray:
    return steps.astype(np.int8).tobytes() if not len(steps) or np.abs(steps).max() < 128 else steps


def _concatenated(parts: list[bytes | np.ndarray]) -> bytes | np.ndarray:
    if all(isinstance(p, bytes) for p in parts):
        return b"".join(parts)
    return np.concatenate([np.frombuffer(p, np.int8).astype(np.int32) if isinstance(p, bytes) else p for p in parts])


def counter(path: str) -> PrefixCounter:
    """This Python worker's counter for a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PrefixCounter(path)
    return _COUNTERS[path]


def _join(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... size[0] of them, then those of the next."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(start - before, size)


def _count(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in cut(batches, "text"):
            texts = pc.fill_null(batch.column("text").cast(pa.string()), "")
            lists = pc.ascii_split_whitespace(texts)
            offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
            full = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
            of = (np.concatenate([[0], np.cumsum(full)]))[offsets - offsets[0]]
            coded = flat.filter(pa.array(full)).dictionary_encode()
            known = [own.steps(p) for p in coded.dictionary.to_pylist()]
            table = _concatenated(known)
            table = np.frombuffer(table, np.int8) if isinstance(table, bytes) else table
            size = np.array([len(k) for k in known], np.int64)
            pick = coded.indices.to_numpy(zero_copy_only=False)
            steps = table[_join((np.cumsum(size) - size)[pick], size[pick])] if len(pick) else np.zeros(0, np.int8)
            ends = np.concatenate([[0], np.cumsum(size[pick])])[of]
            total = np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])
            out, tokens = [], []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                part = steps[a:max(a, b - 1)]  # without the last blank
                tokens.append(int(total[b] - total[a]))
                wide = part.dtype != np.int8 and len(part) and np.abs(part).max() >= 128
                out.append(b"\4" + part.astype("<i4").tobytes() if wide else b"\1" + part.astype(np.int8).tobytes())
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.record_batch([batch.column("id"), n_bytes, pa.array(tokens, pa.int64()), pack(out)], ["id", "n_bytes", "n_tokens", "steps"])
    return count


def prefix_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, steps) of every row.

    ``n_bytes`` and ``n_tokens`` are those of the whole text, without added special tokens; a special string inside a
    text is one token.  ``steps``: its first byte tells the bytes of an item (1 or 4, signed, little-endian), then an
    item for each character of the normalised text.  A null text counts as empty: no bytes, tokens or steps.  Null and
    repeated ids are kept; an empty table gives an empty one; other columns are not read.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, steps binary"
    return base.mapInArrow(_count(path), schema).withColumnRenamed("id", id_col)


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token counts of the prefixes of 1, 2, ... characters."""
    return np.cumsum(np.frombuffer(steps, f"<i{steps[0]}", offset=1), dtype=np.int64)


def tokens_of_prefix(steps: Column | str, n_chars: int) -> Column:
    """Tokens of the first ``n_chars`` characters of the normalised text, or of all if it is shorter."""
    @F.arrow_udf("long")
    def tokens(tables: pa.Array) -> pa.Array:
        return pa.array([None if s is None else int(prefix_counts(s)[:n_chars][-1:].sum()) for s in tables.to_pylist()], pa.int64())
    return tokens(steps)


def chars_within(steps: Column | str, max_tokens: int) -> Column:
    """Characters of the longest prefix of the normalised text that has at most ``max_tokens`` tokens."""
    @F.arrow_udf("long")
    def chars(tables: pa.Array) -> pa.Array:
        fit = [None if s is None else np.flatnonzero(prefix_counts(s) <= max_tokens) for s in tables.to_pylist()]
        return pa.array([None if f is None else int(f[-1]) + 1 if len(f) else 0 for f in fit], pa.int64())
    return chars(steps)
