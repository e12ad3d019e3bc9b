"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies, in Arrow batches.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: the pair whose union has the best score is merged, ties
go to the leftmost, and unions with the new neighbours join the agenda. No piece of such a vocabulary has a blank mark
after another character, nor a line feed among others, so a text is the row of its segments (blank marks and what
follows, cut at line feeds) and merges never cross a segment's border. The short segments of a batch are worked off together, a row of pair scores each; longer ones use a
heap. Each distinct segment needs its agenda once for as long as a worker remembers it: what it has learnt is kept from
task to task, within a bound in bytes.

Every batch is checked against the sentencepiece library: each segment that is new to the worker is encoded by it, each
whole text is decoded by it, and a difference stops the job. Defined results: null text is encoded as empty (the end id
alone); texts may have any length; repeated rows give repeated rows; an empty table gives an empty result; other columns
are ignored, so names can't clash.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldloom.llm.common import arrow_pieces, in_small_batches

BLANK = "▁"
#: Bytes of the distinct segments in each of a worker's two generations, about; only speed depends on it.
REMEMBERED_BYTES = 20_000_000
#: What an entry costs beside its characters and ids.
ENTRY_BYTES = 190
#: Segments up to this many characters are worked off together.
SHORT = 32
_NEVER = -np.inf


class MergeCodec:
    """Encoder and decoder of one model file. Ids of a segment are kept as the bytes of an int32 array."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        special = {i for i in range(len(pieces)) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in special}
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = {int(p[1:-1], 16): i for i, p in enumerate(pieces) if lib.is_byte(i)}
        self.unknown, self.end = lib.unk_id(), lib.eos_id()
        self.crossing = any(BLANK in p.lstrip(BLANK) for p in self.ids)
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        self.cuts = "".join(c for c in "\n\t\v\f" if c not in joined)
        mark = BLANK + re.escape(self.cuts)
        self.pattern = re.compile(f"{BLANK}+[^{mark}]*|[^{mark}]+" + (f"|[{re.escape(self.cuts)}]" if self.cuts else ""))
        self.raw = [b"" if lib.is_control(i) else bytes([int(p[1:-1], 16)]) if lib.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.printed = [str(i) for i in range(len(pieces))]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self._pair_table()
        self.lead = self.long_segment(BLANK) + self.long_segment(self.cuts[0]) if self.cuts else b""

    def _pair_table(self) -> None:
        """Sorted keys of all pairs of symbols whose union is a piece; a character that is no piece has a symbol too."""
        n = len(self.raw)
        others = sorted({c for p in self.ids for c in p} - self.ids.keys())
        symbols = self.ids | {c: n + k for k, c in enumerate(others)}
        self.width = n + len(others) + 1
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for text, symbol in symbols.items():
            if len(text) == 1:
                self.symbol_of[ord(text)] = symbol
        pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                left, right = symbols.get(p[:k]), symbols.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = i
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        unions = np.fromiter(pairs.values(), np.int32, len(pairs))
        order = np.argsort(keys)
        self.pair_keys, self.pair_unions = keys[order], unions[order]
        self.score_of = np.full(self.width, _NEVER)
        for p, i in self.ids.items():
            self.score_of[i] = self.scores[p]

    def _unions(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the unions of symbol pairs, -1 where the union is no piece."""
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_unions[at], -1)

    def short_segments(self, texts: list[str]) -> list[bytes]:
        """Ids of segments of at most SHORT characters, all agendas side by side."""
        out: list[bytes] = [b""] * len(texts)
        if not texts:
            return out
        lengths = np.array([len(t) for t in texts])
        starts = np.cumsum(lengths) - lengths
        symbols = self.symbol_of[np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)]
        for size in np.unique(lengths).tolist():
            rows = np.nonzero(lengths == size)[0]
            sym = symbols[starts[rows][:, None] + np.arange(size)]
            count = np.full(len(rows), size)
            if size > 1:
                union = self._unions(sym[:, :-1], sym[:, 1:])
                self._merge(sym, union, np.where(union >= 0, self.score_of[union], _NEVER), count)
            inside = np.arange(size) < count[:, None]
            plain = (((sym >= 0) & (sym < len(self.raw))) | ~inside).all(axis=1)
            blob, wide = np.ascontiguousarray(sym, np.int32).tobytes(), 4 * size
            for k, (r, n, ok) in enumerate(zip(rows.tolist(), count.tolist(), plain.tolist(), strict=True)):
                out[r] = blob[k * wide : k * wide + 4 * n] if ok else self.long_segment(texts[r])
        return out

    def _merge(self, sym: np.ndarray, union: np.ndarray, score: np.ndarray, count: np.ndarray) -> None:
        """Merge the best pair of each row, the leftmost on ties, until no row has one. Works in place."""
        live = np.nonzero(score.max(axis=1) > _NEVER)[0]
        columns = np.arange(sym.shape[1])
        while len(live):
            s, u, v, n = sym[live], union[live], score[live], count[live] - 1
            lines = np.arange(len(live))
            best = v.argmax(axis=1)
            s[lines, best] = u[lines, best]
            shift = np.minimum(columns + (columns > best[:, None]), sym.shape[1] - 1)
            s = np.take_along_axis(s, shift, 1)
            if u.shape[1] > 1:
                u, v = (np.take_along_axis(x, np.minimum(shift[:, :-1], u.shape[1] - 1), 1) for x in (u, v))
            for at in (best - 1, best):
                ok = np.nonzero((at >= 0) & (at < n - 1))[0]
                k = at[ok]
                found = self._unions(s[ok, k], s[ok, k + 1])
                u[ok, k] = found
                v[ok, k] = np.where(found >= 0, self.score_of[found], _NEVER)
            v[columns[: v.shape[1]] >= n[:, None] - 1] = _NEVER
            sym[live], union[live], score[live], count[live] = s, u, v, n
            live = live[v.max(axis=1) > _NEVER]

    def _spell(self, symbol: str) -> list[int]:
        return [self.byte_ids[b] for b in symbol.encode()] if self.byte_ids else [self.unknown]

    def long_segment(self, text: str) -> bytes:
        """Ids of one segment of any length, by a heap of pairs; stale entries are skipped."""
        symbols: list[str | None] = list(text)
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda: list[tuple[float, int, int, str]] = []
        scores = self.scores

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (score := scores.get(union := symbols[left] + symbols[right])) is not None:
                heapq.heappush(agenda, (-score, left, right, union))

        for i in range(len(symbols) - 1):
            propose(i, i + 1)
        while agenda:
            _, left, right, union = heapq.heappop(agenda)
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != union or after[left] != right:
                continue
            symbols[left], symbols[right] = union, None
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            propose(before[left], left)
            propose(left, after[left])
        ids = chain.from_iterable([self.ids[s]] if s in self.ids else self._spell(s) for s in symbols if s is not None)
        return np.fromiter(ids, np.int32).tobytes()

    def _learn(self, parts: set[str]) -> None:
        """Have all parts in the young generation; new ones are encoded and compared with the library."""
        young, old = self.young, self.old
        need = [p for p in parts if p not in young]
        size = sum(map(len, need)) * 3 + len(need) * ENTRY_BYTES
        if self.held + size > REMEMBERED_BYTES and young:
            self.old = old = young | {p: old[p] for p in need if p in old}
            self.young = young = {p: old[p] for p in parts if p in old}
            need = [p for p in need if p not in young]
            self.held = sum(map(len, young)) * 3 + len(young) * ENTRY_BYTES
            size = sum(map(len, need)) * 3 + len(need) * ENTRY_BYTES
        self.held += size
        new = []
        for p in need:
            if (known := old.get(p)) is not None:
                young[p] = known
            else:
                new.append(p)
        short = [p for p in new if len(p) <= SHORT]
        found = dict(zip(short, self.short_segments(short), strict=True)) | {p: self.long_segment(p) for p in new if len(p) > SHORT}
        # The library puts a blank mark in front of a text: a segment is given without its own, or after a cut.
        asked = [p[1:].replace(BLANK, " ") if p.startswith(BLANK) else self.cuts[0] + p for p in found if len(p) > 1]
        theirs = self.library.encode(asked, num_threads=1)
        ours = [found[p] if p.startswith(BLANK) else self.lead + found[p] for p in found if len(p) > 1]
        if [4 * len(x) for x in theirs] != [len(x) for x in ours] or np.fromiter(chain.from_iterable(theirs), np.int32).tobytes() != b"".join(ours):
            raise ValueError("the agenda and the sentencepiece library disagree on ids")
        young.update(found)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last; as the library with an end id only and no sampling."""
        split = [self._split(t) for t in texts]
        self._learn(set(chain.from_iterable(split)))
        young, end = self.young, np.int32(self.end).tobytes()
        return [np.frombuffer(b"".join([young[p] for p in parts]) + end, np.int32).tolist() for parts in split]

    def _split(self, text: str) -> list[str]:
        marked = BLANK + text.replace(" ", BLANK) if text else ""
        return [marked] if self.crossing and marked else self.pattern.findall(marked)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces and bytes joined, the blank that encoding put in front removed."""
        raw = self.raw
        return b"".join([raw[i] for i in ids]).removeprefix(b" ").decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def codec(model_file: str) -> MergeCodec:
    return MergeCodec(model_file)


def round_trip(docs: DataFrame, model_file: str, keep_ids: bool = False) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256, and with keep_ids the ids and the decoded text."""
    more = ", ids array<int>, decoded string" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model_file)
        for batch in arrow_pieces(batches, 2_000_000):
            found = own.encode([t or "" for t in batch.column("text").to_pylist()])
            decoded = [own.decode(ids) for ids in found]
            if decoded != [own.library.decode(ids) for ids in found]:
                raise ValueError("the codec and the sentencepiece library disagree on decoded texts")
            printed = own.printed
            out = {
                "doc_id": batch.column("doc_id").cast(pa.int64()),
                "n_tokens": pa.array([len(ids) for ids in found], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(" ".join([printed[i] for i in ids]).encode()).hexdigest() for ids in found], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            }
            if keep_ids:
                out |= {"ids": pa.array(found, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(out)

    return in_small_batches(docs).select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
