"""Sequence packing by minimum bin slack.

Each task turns its documents into token ids and packs them as it reads, so
nothing is shuffled and memory is bounded by the pool, whatever the input.
Documents longer than a window fill whole windows first.  What remains goes to
a pool of pieces, of which the task keeps only the multiset of lengths to
decide: for every window a subset-sum program over a bitset (bit t: some
sub-multiset sums to t) finds the total closest to the capacity, and the
recorded bitsets give back how many pieces of each length to take.  If the
capacity itself cannot be met, the largest piece left is cut to fill the slack.
Once a task has read everything, the tokens that fill no window are laid out in
sequences whose lengths are powers of two, which need no padding.

Token ids: the tokenizer's normaliser and splitter never look across ASCII
white space, so ids are made once for each distinct word and kept in a bounded
table; a document's ids are its words' ids joined.

Defined cases: null text is empty, and an empty text is its end token alone; a
null id is carried as null; repeated rows are packed as often as they occur;
ties between equal lengths go to the piece read last.  Sequence ids are unique
over tasks and follow the partitions of the input.  Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 2
#: Distinct words a task keeps ids for; tokens the pool holds before it is packed down.
WORDS, POOL_TOKENS = 3 << 18, 1 << 20
#: Rows that are tokenized at once.
BATCH = 4096
PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, tokens binary")


class WordIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    Unknown words are split into a stem of letters and closing marks, which the
    tokenizer's splitter separates as well, so a stem is encoded once for all
    the marks behind it; any other word goes to the tokenizer whole.  A-Z are
    lowered first, as the tokenizer does, unless that could make up one of its
    special tokens."""

    MARKS = b".,;:!?|*&%$#"

    def __init__(self, tokenizer_file: str, keep: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(tokenizer_file), keep
        self.known: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes | None] = {}       # None: not letters only
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)      # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode_words(self, words: list[bytes]) -> Iterator[bytes]:
        for at in range(0, len(words), 1024):
            part = words[at:at + 1024]
            got = self.tokenizer.encode([w.decode() for w in part], is_pretokenized=True, add_special_tokens=False)
            raw, a = np.array(got.ids, "<u4").tobytes(), 0
            for b in (4 * np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(part)), side="right")).tolist():
                yield raw[a:b]
                a = b

    def encode_letters(self, words: list[bytes]) -> Iterator[bytes]:
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) != len(part):
                yield from self.encode_words(part)
                continue
            raw, a = ids.tobytes(), 0
            for b in ends.tolist():
                yield raw[a:b]
                a = b

    @staticmethod
    def letters(stem: bytes) -> bool:
        if stem.isascii():
            return stem.isalpha()
        text = stem.decode()
        return text.isalpha() and text.lower().isalpha()

    def learn(self, words: list[bytes]) -> None:
        if len(self.stems) + 2 * len(words) > self.keep:
            self.stems.clear()
        stems, marks = self.stems, self.MARKS
        cut = [w.rstrip(marks) for w in words]
        fresh = [x for x in {*cut, *(w[len(x):] for w, x in zip(words, cut))} if x not in stems]
        plain = [x for x in fresh if self.letters(x)]
        stems.update(dict.fromkeys(fresh))
        stems.update(zip(plain, self.encode_letters(plain)))
        closing = [x for x in fresh if not x.rstrip(marks)]
        stems.update(zip(closing, self.encode_words(closing)))
        odd = [w for w, x in zip(words, cut) if stems[x] is None]
        self.known.update(zip(odd, self.encode_words(odd)))
        self.known.update((w, stems[x] if len(x) == len(w) else stems[x] + stems[w[len(x):]])
                          for w, x in zip(words, cut) if stems[x] is not None)

    def texts(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text, END_ID last.  The table holds the words of these
        texts, and beyond them `keep` at most."""
        special = pc.match_substring(texts, "<|")
        words = pc.ascii_split_whitespace(pc.if_else(special, texts, pc.ascii_lower(texts)))
        coded = words.flatten().dictionary_encode()
        distinct = [w.encode() for w in coded.dictionary.to_pylist()]
        found = list(map(self.known.get, distinct))
        self.learn([w for w, x in zip(distinct, found) if x is None])
        found = [self.known[w] if x is None else x for w, x in zip(distinct, found)]
        if len(self.known) > self.keep:
            self.known = dict(zip(distinct, found))        # the words of these texts stay, the frequent ones among them
        found.append(np.array([END_ID], "<u4").tobytes())

        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = words.offsets.to_numpy() - words.offsets[0].as_py()
        order = np.insert(coded.indices.to_numpy(), ends[1:], len(distinct))       # an end behind each text's words
        size = sizes[order]
        stop = np.cumsum(size)
        ids = flat[np.repeat(np.cumsum(sizes)[order] - stop, size) + np.arange(len(size) and stop[-1])]
        a = 0
        for b in stop[ends[1:] + np.arange(len(texts))].tolist():
            yield ids[a:b].tobytes()
            a = b


#: A Python worker runs many tasks; its word table stays with it.
_IDS: dict[str, WordIds] = {}


def word_ids(tokenizer_file: str) -> WordIds:
    if tokenizer_file not in _IDS:
        _IDS[tokenizer_file] = WordIds(tokenizer_file)
    return _IDS[tokenizer_file]


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The sub-multiset of lengths whose total is closest to capacity, not
    above: length -> how many.  The longest length is taken at least once, as
    long pieces are the hardest to place later."""
    lengths = sorted(counts, reverse=True)
    first, room, left = lengths[0], capacity - lengths[0], dict(counts)
    left[first] -= 1
    mask, want = (1 << (room + 1)) - 1, 1 << room
    reach, states = 1, []
    for length in lengths:
        n = min(left[length], room // length)
        if n <= 0:
            continue
        states.append((length, n, reach))
        step = 1
        while n > 0 and not reach & want:          # n copies by doubling: 1, 2, 4, ..., rest
            take = min(step, n)
            reach |= (reach << (length * take)) & mask
            n, step = n - take, step * 2
        if reach & want:
            break
    total, taken = reach.bit_length() - 1, {first: 1}
    for length, n, before in reversed(states):
        k = next(k for k in range(n + 1) if total >= k * length and before >> (total - k * length) & 1)
        if k:
            taken[length] = taken.get(length, 0) + k
            total -= k * length
    return taken


class Packer:
    def __init__(self, capacity: int, base: int):
        self.capacity, self.next_id = capacity, base
        self.docs: dict[int, list] = {}                      # key -> [doc_id, ids, tokens, pieces still out]
        self.pool: dict[int, list[tuple[int, int]]] = defaultdict(list)      # length -> [(key, start)]
        self.pooled, self.keys, self.rows = 0, 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n, key = len(ids) // 4, self.keys
        self.keys += 1
        self.docs[key] = [doc_id, ids, n, 0]
        whole = n - n % self.capacity
        self.docs[key][3] = whole // self.capacity + (n > whole)
        for start in range(0, whole, self.capacity):
            self.sequence([(key, start, self.capacity)])
        if n > whole:
            self.pool[n - whole].append((key, whole))
            self.pooled += n - whole
        if self.pooled >= POOL_TOKENS:
            self.pack(POOL_TOKENS // 2)

    def sequence(self, pieces: list[tuple[int, int, int]]) -> None:
        offset = 0
        for key, start, length in pieces:
            doc = self.docs[key]
            self.rows.append((doc[0], start, length, doc[2], self.next_id, offset, doc[1][4 * start:4 * (start + length)]))
            offset += length
            doc[3] -= 1
            if not doc[3]:
                del self.docs[key]
        self.next_id += 1

    def take(self, length: int) -> tuple[int, int, int]:
        key, start = self.pool[length].pop()
        if not self.pool[length]:
            del self.pool[length]
        self.pooled -= length
        return key, start, length

    def cut(self, room: int) -> tuple[int, int, int]:
        """Up to room tokens of the longest piece; what is left of it stays in the pool."""
        key, start, length = self.take(max(self.pool))
        if length > room:
            self.pool[length - room].append((key, start + room))
            self.pooled += length - room
            self.docs[key][3] += 1
        return key, start, min(length, room)

    def pack(self, down_to: int) -> None:
        """Fill windows until fewer than down_to tokens, or no whole window, are left."""
        while self.pooled >= max(down_to, self.capacity):
            taken = fill({k: len(v) for k, v in self.pool.items()}, self.capacity)
            pieces = [self.take(length) for length, n in taken.items() for _ in range(n)]
            while slack := self.capacity - sum(p[2] for p in pieces):
                pieces.append(self.cut(slack))
            self.sequence(pieces)

    def finish(self) -> None:
        self.pack(0)
        while self.pooled:
            room, pieces = 1 << (self.pooled.bit_length() - 1), []
            while room:
                pieces.append(self.cut(room))
                room -= pieces[-1][2]
            self.sequence(pieces)

    def flush(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = zip(*rows) if rows else [()] * 7
        return pa.record_batch([pa.array(c, pa.binary() if i == 6 else pa.int64()) for i, c in enumerate(columns)],
                               names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"])


def _packed(tokenizer_file: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = word_ids(tokenizer_file), Packer(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                for doc_id, tokens in zip(part["id"].to_pylist(), ids.texts(part["text"])):
                    packer.add(doc_id, tokens)
                    if len(packer.rows) >= 2048:
                        yield packer.flush()
        packer.finish()
        yield packer.flush()
        pa.default_memory_pool().release_unused()        # the worker lives on
    return run


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset
    and tokens (the ids, little-endian unsigned 32-bit).  `tokenizer_file` must
    be readable by every executor."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).mapInArrow(_packed(tokenizer_file, capacity), PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
