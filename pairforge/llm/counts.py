"""Token counts by a compiled finite-state transducer.

The merge table is compiled into a deterministic transducer.  After each symbol
of a piece, the tokens of the prefix read so far are fixed by its last token,
and which tokens may follow which is a property of the pair alone.  So a state
holds the longest suffix that can still grow into a token, with the last tokens
and relative counts at the positions of that suffix; a transition is annotated
with the change of the token count.  States and transitions are compiled when a
text first needs them and then shared by all texts of the worker.

Long texts are read in chunks.  A chunk's map from the state before it to the
state after it is (open head, count of the closed words, open tail); the maps
compose associatively and are combined by a parallel prefix scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import raw_texts, slices
from pairforge.llm.tokens import SPACE, PieceMemo, Pieces, WordMemo, by_pieces

#: Characters per chunk.
CHUNK = 1 << 16
_EDGE = re.compile(f"[^{SPACE}]*")


class Transducer:
    """Counts the tokens of one piece of the vocabulary's pre-tokenizer."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        self.vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.parts = {a + b: (i, a, b) for (a, b), i in self.rank.items()}
        # prefixes of tokens, as tuples of symbols would be slow: a final symbol is kept as its own string
        self.prefixes = {w[:i] for t in self.vocab for w in [self._stem(t)] for i in range(1, len(w) + 1)}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.states: dict[tuple, int] = {}
        self.content: list[tuple] = []
        self.moves: dict[tuple[int, str], tuple[int, int]] = {}
        self.ends: dict[tuple[int, str], int] = {}
        self.start = self._state(("", ("",), (0,)))

    def _stem(self, token: str) -> str:
        return token[: -len(self.end)] if self.end and token.endswith(self.end) else token

    def _symbols(self, token: str) -> list[str]:
        stem = self._stem(token)
        symbols = list(stem)
        if len(stem) < len(token):
            symbols[-1] += self.end
        return symbols

    def _merged(self, symbols: list[str]) -> list[str]:
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:], strict=False), key=lambda p: self.rank.get(p, 1 << 60))
            if best not in self.rank:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == best:
                    out.append(best[0] + best[1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _follows(self, left: str, right: str) -> bool:
        """Whether the two tokens stay apart when their joined symbols are merged.

        Merges are undone from the latest back, on the side of the border that
        was finished last; if the parts that then meet would have merged sooner,
        the pair never stands.  Of equal merges the left one comes first.
        """
        if (found := self.whole.get(right)) is None:
            found = self.whole[right] = self._merged(self._symbols(right)) == [right]
        if not found or not left:
            return found
        if (ok := self.pairs.get((left, right))) is not None:
            return ok
        key, bound, rank, parts = (left, right), 1 << 60, self.rank, self.parts
        while True:
            if rank.get((left, right), bound) < bound:
                ok = False
                break
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                ok = True
                break
            if b is None or (a is not None and a[0] > b[0]):
                bound, left = a[0], a[2]
            else:
                bound, right = b[0] + 1, b[1]
        self.pairs[key] = ok
        return ok

    def _state(self, content: tuple) -> int:
        if (found := self.states.get(content)) is None:
            found = self.states[content] = len(self.content)
            self.content.append(content)
        return found

    def _step(self, state: int, symbol: str, last: bool) -> tuple[str, int, str]:
        """Last token after the symbol, the change of the count, and the suffix."""
        suffix, tokens, counts = self.content[state]
        grown = suffix + symbol
        for at in range(len(grown)):
            token = grown[at:] + (self.end if last else "")
            if token in self.vocab and self._follows(tokens[at], token):
                return token, counts[at] + 1, grown
        raise ValueError(f"symbol {symbol!r} is not in the vocabulary")

    def _move(self, state: int, symbol: str) -> tuple[int, int]:
        _, tokens, counts = self.content[state]
        token, change, grown = self._step(state, symbol, False)
        keep = next((i for i in range(len(grown)) if grown[i:] in self.prefixes), len(grown))
        content = (grown[keep:], (*tokens[keep:], token), tuple(c - change for c in (*counts[keep:], change)))
        found = self.moves[state, symbol] = self._state(content), change
        return found

    def count(self, piece: str) -> int:
        state, total, moves = self.start, 0, self.moves
        body = piece[:-1] if self.end else piece
        for symbol in body:
            state, change = moves.get((state, symbol)) or self._move(state, symbol)
            total += change
        if self.end:
            key = state, piece[-1]
            if (change := self.ends.get(key)) is None:
                change = self.ends[key] = self._step(state, piece[-1], True)[1]
            total += change
        return total


class TokenCounter:
    """Counts of whole texts, equal to the library's for vocabularies that drop
    white space (``word_bpe_49k.json``)."""

    #: States after which a worker compiles anew, so that memory stays bounded.
    MAX_STATES = 400_000

    def __init__(self, path: str):
        self.path, self.pieces = path, Pieces(path)
        if not self.pieces.dropped:
            raise ValueError("the transducer needs a vocabulary that drops white space")
        self.transducer = Transducer(path)
        self.piece_counts = WordMemo(lambda pieces: [1 if p[0] == "\0" else self.transducer.count(p) for p in pieces])
        self.memo = WordMemo(self._many)
        self.plain = PieceMemo(lambda piece: self.transducer.count(self.pieces.spelt(piece)))

    def _many(self, words: list[str]) -> list[int]:
        cut = [self.pieces.of(w) for w in words]
        self.piece_counts.learn(cut)
        get = self.piece_counts.__getitem__
        return [sum(map(get, p)) for p in cut]

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.transducer.content) > self.MAX_STATES:
            self.transducer = Transducer(self.path)
        long = [self._long([t[i : i + CHUNK] for i in range(0, len(t), CHUNK)]) if len(t) > CHUNK else None for t in texts]
        short = iter(self._short([t for t in texts if len(t) <= CHUNK]))
        return [next(short) if n is None else n for n in long]

    def _short(self, texts: list[str]) -> list[int]:
        return by_pieces(texts, self.pieces, self.plain, self.memo, sum)

    def _one(self, word: str) -> int:
        return self._many([word])[0] if word else 0

    def chunk_map(self, chunk: str) -> tuple[str, int | None, str]:
        """(open head, tokens of the closed words, open tail); a chunk without
        white space is all head and has no count."""
        first = _EDGE.match(chunk).end()
        if first == len(chunk):
            return chunk, None, ""
        last = max(map(chunk.rfind, SPACE)) + 1
        return chunk[:first], self._short([chunk[first:last]])[0], chunk[last:]

    def compose(self, a: tuple, b: tuple) -> tuple:
        if a[1] is None and b[1] is None:
            return a[0] + b[0], None, ""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self._one(a[2] + b[0]) + b[1], b[2]

    def _long(self, chunks: list[str]) -> int:
        head, body, tail = scan([self.chunk_map(c) for c in chunks], self.compose)[-1]
        return self._one(head) + (body or 0) + self._one(tail)




def scan(maps: list, compose) -> list:
    """Inclusive prefix scan of an associative composition, by doubling pairs."""
    if len(maps) < 2:
        return maps
    halves = scan([compose(maps[i], maps[i + 1]) for i in range(0, len(maps) - 1, 2)], compose)
    out = [maps[0]]
    for i in range(1, len(maps)):
        out.append(halves[i // 2] if i % 2 else compose(halves[i // 2 - 1], maps[i]))
    return out


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_bytes, n_tokens and over_limit.

    Null text counts as empty: no bytes, no tokens.  Repeated rows are counted
    row by row; other columns of the input are not read.  ``tokenizer`` is the
    path of a .json vocabulary that every executor can open.
    """
    source = documents.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    kind = source.schema["k"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer)
        for batch in slices(batches, "t", 1 << 22):
            raw = raw_texts(batch.column("t"))
            n = counter.counts([t.decode() for t in raw])
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(map(len, raw), pa.int64()), pa.array(n, pa.int64())], names=["k", "b", "n"]
            )

    counted = source.mapInArrow(run, f"k {kind.simpleString()}, b long, n long")
    return counted.select(
        F.col("k").alias(key), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit")
    )
