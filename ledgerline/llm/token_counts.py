"""Token counts with a whole-token shortcut.

A byte-level BPE tokenizer cuts a text into pre-tokens and merges each on its
own, so a text's count is the sum over its pre-tokens.

1. Offline, once on the driver: `prove` runs the merges on every string of the
   vocabulary and keeps those that come out as that one token.  (A string in the
   vocabulary need not: merges of lower rank may cut it another way.)  The proof
   travels as one bit for each id.
2. In the tasks a pre-token that is a proven string counts one, by one look-up.
   Only the rest is merged; the counts of recent ones are kept in a bounded table.

Special strings inside a text are one token each and cut the text, as the
library does by default; nothing is added around a text, cut off or padded.
Rows stay where they are: no shuffle, and a task holds one Arrow batch and the
pre-tokens of `CUT` characters at a time.

Defined cases: null text is empty, and an empty text has 0 bytes and 0 tokens; a
null id is carried as null; repeated rows are counted as often as they occur; an
empty table gives an empty result.  Other columns are ignored.  A tokenizer of
another kind raises ValueError.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of byte-level BPE, fixed value.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Merged pre-tokens whose counts a task keeps; characters cut into pre-tokens at once.
KEEP, CUT = 1 << 18, 1 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 bytes for themselves, the others in order from U+0100."""
    spare = iter(range(256, 512))
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173 else chr(next(spare)) for b in range(256)]


def load(tokenizer_file: str):
    """The library's tokenizer and its special strings, longest first."""
    from tokenizers import Tokenizer

    with open(tokenizer_file, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model, added = spec["pre_tokenizer"] or {}, spec["model"], spec["added_tokens"]
    plain = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]
             and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
             and not any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not plain:
        raise ValueError(f"not a plain byte-level BPE tokenizer: {tokenizer_file}")
    return Tokenizer.from_file(tokenizer_file), sorted((a["content"] for a in added), key=len, reverse=True)


def prove(tokenizer_file: str) -> bytes:
    """One bit for each id: its string, merged alone, is that one token."""
    tokenizer, special = load(tokenizer_file)
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    proven = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
    for string, i in vocabulary.items():
        merged = tokenizer.model.tokenize(string) if string not in special else []
        proven[i] = len(merged) == 1 and merged[0].id == i
    return np.packbits(proven).tobytes()


class TokenCounter:
    """Token counts of single texts."""

    class Counts(dict):
        """Pre-token -> its number of tokens; a missing one is merged and kept."""

        def __init__(self, whole: dict[str, int], merge, keep: int):
            super().__init__(whole)
            self.whole, self.merge, self.room = whole, merge, len(whole) + keep

        def __missing__(self, pre_token: str) -> int:
            if len(self) >= self.room:
                self.clear()
                self.update(self.whole)
            n = self[pre_token] = self.merge(pre_token)
            return n

    def __init__(self, tokenizer_file: str, proof: bytes, keep: int = KEEP, cut: int = CUT):
        self.tokenizer, special = load(tokenizer_file)
        self.letters, self.cut, self.merged = dict(enumerate(byte_letters())), cut, 0
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        byte_of = {letter: b for b, letter in self.letters.items()}
        proven, whole = np.unpackbits(np.frombuffer(proof, np.uint8)).astype(bool), {}
        for string, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if proven[i]:
                try:
                    whole[bytes(byte_of[c] for c in string).decode()] = 1
                except (KeyError, UnicodeDecodeError):
                    pass                                    # part of a character: no text has it as a pre-token
        self.whole = whole
        self.counts = self.Counts(whole, self.merge, keep)
        self.pre_tokens = regex.compile(PRE_TOKENS).findall
        self.border = regex.compile(r"(?<=\S) ")            # no pre-token holds a space behind something else

    def merge(self, pre_token: str) -> int:
        self.merged += 1
        return len(self.tokenizer.model.tokenize(pre_token.encode().decode("latin-1").translate(self.letters)))

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about `cut` characters that no pre-token crosses."""
        at = 0
        while len(text) - at > self.cut:
            border = self.border.search(text, at + self.cut)
            if not border:
                break
            yield text[at:border.start()]
            at = border.start()
        yield text[at:] if at else text

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        known = self.counts.__getitem__
        return len(parts) - 1 + sum(sum(map(known, self.pre_tokens(piece))) for part in parts for piece in self.pieces(part))


#: A Python worker runs many tasks; its tables stay with it.
_COUNTERS: dict[str, TokenCounter] = {}


def _counted(tokenizer_file: str, proof: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _COUNTERS.get(tokenizer_file) or _COUNTERS.setdefault(tokenizer_file, TokenCounter(tokenizer_file, proof))
        for batch in batches:
            n = [counter.count(text.as_py()) for text in batch["text"]]
            yield pa.record_batch({"doc_id": batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": pa.array(n, pa.int64())})
    return run


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit`
    tokens): one row per document.  `tokenizer_file` must be readable by every
    executor."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes"))
    return (rows.mapInArrow(_counted(tokenizer_file, prove(tokenizer_file)), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
