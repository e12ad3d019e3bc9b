"""Alignment of two tokenizers' tokens, by dividing at ends that both share.

Both tokenizers cut the same bytes. The tokens of an interval are divided at a shared end near the middle: the first
tokenizer's ends nearest to the middle are looked up among the second one's by bisection, first the middle one, then twice
as many on both sides each time. Both halves go on in the same way; an interval without a shared end inside is a group.
All intervals of a batch take a step together, in numpy.

A text is worked off in chunks, cut before each lone blank between characters that aren't white space. No token of either
vocabulary reaches over such a place (tokens of the first hold blanks in front alone, as its splitting pattern asks for, and
pieces of the second have a blank mark in front alone, which is checked when they are read), so a chunk's tokens are the
same in every text and both tokenizers share an end there. A worker keeps the chunks it has met, within a bound on their
number that only speed depends on.

Tokens that end together are one a suffix of the other. The id pairs that can be linked are therefore known from the two
vocabularies; their number bounds the counts that reach the driver and the workers, whatever the corpus holds. Texts are
encoded once: their links' pair numbers are written to the shared folder with each batch's counts, and looked up there.

Defined results: null and empty texts, and texts whose joined bytes differ from a blank and the text (such as those with a
blank mark of their own) have no tokens, zero counts and an empty column; rows without doc_id are kept; repeated rows count
each time; all ids of the highest count of a second id are its best; texts may have any length; an empty table gives an
empty result; other columns are ignored, so names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.common import arrow_pieces, materialise

BLANK = "▁"
#: Chunks that a worker remembers before it forgets a half; only speed depends on it, as on the next two.
REMEMBERED = 400_000
#: A chunk of more characters is forgotten with them.
LONGEST = 64
#: New chunks that are joined for encoding.
TOGETHER = 500
PIECE_BYTES = 4_000_000

_BORDER = re.compile(f"[\\s{BLANK}]")
_CUT = re.compile(f"(?<=[^\\s{BLANK}]) (?=[^\\s{BLANK}])")


def byte_symbols() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the id pairs whose tokens can end together."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        symbols = byte_symbols()
        with open(first, encoding="utf-8") as file:
            special = {t["content"] for t in json.load(file).get("added_tokens", [])}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            if token not in special:
                self.a_bytes[i] = bytes(symbols[c] for c in token)
        self.b_bytes, self.divisible = [], True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace(BLANK, " ").encode())
                self.divisible &= BLANK not in piece.lstrip(BLANK)
        self.a_size, self.b_size = np.array(list(map(len, self.a_bytes))), np.array(list(map(len, self.b_bytes)))
        by_bytes: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
        for found, tokens in zip(by_bytes, (self.a_bytes, self.b_bytes), strict=True):
            for i, token in enumerate(tokens):
                if token:
                    found[token].append(i)
        keys = {self.key(i, j) for i, t in enumerate(self.a_bytes) for k in range(len(t)) for j in by_bytes[1].get(t[k:], ())}
        keys |= {self.key(i, j) for j, t in enumerate(self.b_bytes) for k in range(len(t)) for i in by_bytes[0].get(t[k:], ())}
        #: Sorted keys of all id pairs that can be linked; a pair's number is its place here.
        self.pairs = np.array(sorted(keys), np.int64)
        #: Each token as written inside a group and as its last, of both: `a,` `a|` `b,` `b;`.
        self.written = [f"{i}{end}".encode() for tokens, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(tokens))]
        self.written_size = np.array(list(map(len, self.written)))
        self.forget_all()

    def key(self, a, b):
        return a * len(self.b_bytes) + b

    def forget_all(self) -> None:
        #: Number of each chunk known; by that number: its tokens of both and its groups, the batch that used it last, its groups as written, its links.
        self.known: dict[str, int] = {}
        self.sizes, self.used = np.zeros((0, 3), np.int64), np.zeros(0, np.int64)
        self.groups: list[bytes | None] = []
        self.links: list[bytes | None] = []
        self.batch = 0

    def forget(self) -> None:
        """Of the chunks known, the half that was used last stays."""
        keep = (self.used > np.median(self.used)) & np.fromiter((len(c) <= LONGEST for c in self.known), bool, len(self.known))
        kept = np.nonzero(keep)[0].tolist()
        self.known = {c: k for k, c in enumerate(c for c, k in zip(self.known, keep.tolist(), strict=True) if k)}
        self.sizes, self.used = self.sizes[kept], self.used[kept]
        self.groups, self.links = [self.groups[k] for k in kept], [self.links[k] for k in kept]

    def chunks(self, text: str) -> list[str]:
        """Chunks of a text without the blank that stands before each."""
        return _CUT.split(text) if self.divisible else [text]

    def learn(self, chunks: list[str]) -> None:
        """Chunks are joined again for encoding, as many at a time as is quick; those that can't stand beside others are encoded alone."""
        whole = [self.divisible and c != "" and not _BORDER.match(c[0]) and not _BORDER.match(c[-1]) for c in chunks]
        alone = [[c] for c, w in zip(chunks, whole, strict=True) if not w]
        beside = [c for c, w in zip(chunks, whole, strict=True) if w]
        units = [beside[k : k + TOGETHER] for k in range(0, len(beside), TOGETHER)] + alone
        sizes = [self.sizes]
        lost = self._learn(units, sizes)
        if lost:
            self._learn([[c] for unit in lost for c in unit], sizes)
        self.sizes = np.concatenate(sizes)

    def _learn(self, units: list[list[str]], sizes: list[np.ndarray]) -> list[list[str]]:
        """Encode each unit and take it apart into its chunks; units of several chunks whose bytes are lost come back."""
        texts = [" ".join(u) for u in units]
        a = [e.ids for e in self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        lost = []
        for unit, text, x, y in zip(units, texts, a, b, strict=True):
            whole = f" {text}".encode()
            if x and b"".join(map(self.a_bytes.__getitem__, x)) == whole == b"".join(map(self.b_bytes.__getitem__, y)):
                sizes.append(self._take_apart(unit, np.array(x, np.int64), np.array(y, np.int64)))
            elif len(unit) > 1:
                lost.append(unit)
            else:
                self.known[unit[0]] = len(self.groups)
                self.groups.append(None)
                self.links.append(None)
                sizes.append(np.zeros((1, 3), np.int64))
        return lost

    def _take_apart(self, unit: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ends_a, ends_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        last_a, last_b = shared_ends(ends_a, ends_b, np.array([len(a) - 1]), np.array([len(b) - 1]))
        numbers = np.searchsorted(self.pairs, self.key(a[last_a], b[last_b])).astype("<i4").tobytes()
        # Tokens in the order in which they are written: of each group those of the first, then those of the second.
        code_a, code_b = a.copy(), b + 2 * len(self.a_bytes)
        code_a[last_a] += len(self.a_bytes)
        code_b[last_b] += len(self.b_bytes)
        group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.concatenate([[0], last_b + 1])[group_a]] = code_a
        codes[np.arange(len(b)) + (last_a + 1)[group_b]] = code_b
        words = b"".join(map(self.written.__getitem__, codes.tolist()))
        # Where each chunk ends, in bytes, tokens, groups and what is written.
        ends = np.cumsum(np.fromiter((len(c.encode()) + 1 for c in unit), np.int64, len(unit)))
        n_a, n_b = np.searchsorted(ends_a, ends) + 1, np.searchsorted(ends_b, ends) + 1
        n_groups = np.searchsorted(last_a, n_a)
        upto = np.cumsum(self.written_size[codes])[n_a + n_b - 1]
        before = len(self.groups)
        self.known.update(zip(unit, range(before, before + len(unit)), strict=True))
        for start, end in ((upto, self.groups), (4 * n_groups, self.links)):
            of = words if end is self.groups else numbers
            cuts = start.tolist()
            end.extend(of[i:j] for i, j in zip([0, *cuts], cuts, strict=False))
        return np.diff(np.stack([n_a, n_b, n_groups], axis=1), axis=0, prepend=0)

    def aligned(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], list[bytes]]:
        """Tokens of both and groups (a row each), digest, pair numbers as bytes of each text; only chunks new to the worker are encoded."""
        if len(self.known) > REMEMBERED:
            self.forget()
        cut = [self.chunks(t) if t else [] for t in texts]
        every = list(chain.from_iterable(cut))
        new = list(dict.fromkeys(c for c, k in zip(every, map(self.known.get, every), strict=True) if k is None))
        if new:
            self.learn(new)
        self.batch += 1
        self.used = np.concatenate([self.used, np.zeros(len(self.groups) - len(self.used), np.int64)])
        number = list(map(self.known.__getitem__, every))
        self.used[number] = self.batch
        groups, links = list(map(self.groups.__getitem__, number)), list(map(self.links.__getitem__, number))
        upto = np.cumsum([0, *map(len, cut)])
        sums = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(self.sizes[number], axis=0)])
        sizes, digests, out = np.diff(sums[upto], axis=0), [], []
        for k, (i, j) in enumerate(zip(upto.tolist(), upto[1:].tolist(), strict=False)):
            if i == j or None in groups[i:j]:
                sizes[k] = 0
                digests.append("")
                out.append(b"")
            else:
                digests.append(hashlib.sha256(b"".join(groups[i:j])[:-1]).hexdigest())
                out.append(b"".join(links[i:j]))
        return sizes, digests, out


def shared_ends(a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens, in both, that end together. a and b: ends of all tokens; a_last and b_last: each interval's last token."""
    lo, hi, b_lo, b_hi = np.concatenate([[0], a_last[:-1] + 1]), a_last, np.concatenate([[0], b_last[:-1] + 1]), b_last
    out_a, out_b = [a_last], [b_last]
    while True:
        open_ = (lo < hi) & (b_lo < b_hi)  # only a token before the last can end inside
        lo, hi, b_lo, b_hi = lo[open_], hi[open_], b_lo[open_], b_hi[open_]
        if not len(lo):
            break
        at, met = _near_middle(a, b, lo, hi)
        cut = at >= 0
        at, met = at[cut], met[cut]
        out_a.append(at)
        out_b.append(met)
        lo, hi, b_lo, b_hi = lo[cut], hi[cut], b_lo[cut], b_hi[cut]
        lo, hi, b_lo, b_hi = np.concatenate([lo, at + 1]), np.concatenate([at, hi]), np.concatenate([b_lo, met + 1]), np.concatenate([met, b_hi])
    return np.sort(np.concatenate(out_a)), np.sort(np.concatenate(out_b))


def _near_middle(a: np.ndarray, b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the shared end nearest to its middle, as places in a and b; -1 where there is none before the last token."""
    at, met = np.full(len(lo), -1), np.full(len(lo), -1)
    middle, todo, near, far = (lo + hi - 1) // 2, np.arange(len(lo)), 0, 1
    while len(todo):
        # Tokens at distances near to far - 1 of the middle, on both sides; the nearest comes first.
        steps = np.arange(near, far)
        reach = np.concatenate([steps, -steps[steps > 0]])
        reach = reach[np.argsort(np.abs(reach), kind="stable")]
        probe = middle[todo][:, None] + reach
        inside = (probe >= lo[todo][:, None]) & (probe < hi[todo][:, None])
        row, column = np.nonzero(inside)
        ends = a[probe[row, column]]
        place = np.searchsorted(b, ends)
        hit = np.nonzero(b[np.minimum(place, len(b) - 1)] == ends)[0]
        first_row, first = np.unique(row[hit], return_index=True)
        at[todo[first_row]] = probe[row[hit[first]], column[hit[first]]]
        met[todo[first_row]] = place[hit[first]]
        left = (at[todo] < 0) & ((middle[todo] - far >= lo[todo]) | (middle[todo] + far < hi[todo]))
        todo, near, far = todo[left], far, 2 * far
    return at, met


@lru_cache(maxsize=2)
def vocabularies(first: str, second: str) -> Vocabularies:
    return Vocabularies(first, second)


def _texts(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Each text aligned; one row of each batch has the batch's counts as well."""
    kind = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, counted array<struct<pair: int, n: long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(first, second)
        counted = pa.list_(pa.struct([("pair", pa.int32()), ("n", pa.int64())]))
        for batch in arrow_pieces(batches, PIECE_BYTES):
            sizes, digest, links = both.aligned(batch.column("text").to_pylist())
            numbers, counts = np.unique(np.frombuffer(b"".join(links), "<i4"), return_counts=True)
            own = [[{"pair": p, "n": n} for p, n in zip(numbers.tolist(), counts.tolist(), strict=True)]] + [None] * (len(links) - 1)
            arrays = [*map(pa.array, sizes.T.copy()), pa.array(digest, pa.string()), pa.array(links, pa.binary()), pa.array(own, counted)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links", "counted"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, kind)


def align(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of docs.

    first: path of a byte-level vocabulary; second: path of a piece vocabulary with byte fallback.
    """
    texts = materialise(_texts(docs, first, second), "aligned")
    counts = texts.filter("counted IS NOT NULL").select(F.inline("counted")).groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = vocabularies(first, second).pairs
    of_b, count = pairs % len(vocabularies(first, second).b_bytes), np.zeros(len(pairs), np.int64)
    for row in counts.toLocalIterator():  # at most one row for each pair that the vocabularies allow
        count[row["pair"]] = row["n"]
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, count)
    best = (count > 0) & (count == highest[of_b])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_pieces(batches, PIECE_BYTES, "links"):
            links = [np.frombuffer(x, "<i4") for x in batch.column("links").to_pylist()]
            n = [len(x) for x in links]
            sums = [[int(of[x].sum()) for x in links] for of in (best, count)]
            arrays = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")] + [pa.array(x, pa.int64()) for x in (n, *sums)] + [batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.drop("counted").mapInArrow(look_up, kind)
