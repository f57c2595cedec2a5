"""Token counts of a byte-level BPE by whole tokens.

A vocabulary string that the tokenizer encodes, alone, as that one token is proven whole: wherever it
stands as a pre-token it counts one. The proof covers the whole vocabulary and is made once per
worker, from the tokenizer's file alone. Pre-tokens that are not proven are merged, each distinct one
once while it stays in a bounded memory. Texts are first cut where a space follows something that is
no white space: no pre-token crosses such a place, so the counts of the cuts add up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

REMEMBERED = 400_000  # cuts kept by a worker; when there are more it starts anew

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
# The tokenizer's own pattern for pre-tokens. Characters from U+0250 on are left to its library, as
# tables of letters and digits differ between versions.
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_SURE = "\u0250"


def _byte_spelling() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SPELLING = _byte_spelling()


class Counter:
    """Counts as ``len(tokenizer.encode(text, add_special_tokens=False).ids)`` does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.whole = self._proven()
        self.kept: dict[str, int] = {}  # tokens of cuts without their first space, which all have

    def _proven(self) -> frozenset[str]:
        """The vocabulary's strings that encode as themselves alone."""
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ids = list(vocabulary.values())
        texts = [self.tokenizer.decode([i]) for i in ids]
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return frozenset(t for t, i, e in zip(texts, ids, encoded, strict=True) if e.ids == [i])

    def merged(self, cut: str) -> int:
        """Tokens of a text that has no special strings."""
        if cut in self.whole:
            return 1
        if not cut:
            return 0
        if max(cut) < _SURE:
            pieces = _PRE_TOKEN.findall(cut)
        else:
            pieces = [cut[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(cut)]
        return sum(1 if p in self.whole else self._merge(p) for p in pieces)

    def _merge(self, piece: str) -> int:
        return len(self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(_SPELLING)))

    def _count_plain(self, text: str) -> int:
        if _SPACE_AFTER_SPACE.search(text):
            cuts = _CUT.split(text)
            irregular, cuts = [c for c in cuts if c[:1] != " "], [c[1:] for c in cuts if c[:1] == " "]
            total = sum(map(self.merged, irregular))
        else:
            first, *cuts = text.split(" ")
            total = self.merged(first)
        counts = list(map(self.kept.get, cuts))
        if None in counts:
            if len(self.kept) > REMEMBERED:
                self.kept.clear()
            for i, n in enumerate(counts):
                if n is None:
                    n = self.kept.get(cuts[i])
                    if n is None:
                        n = self.kept[cuts[i]] = self.merged(" " + cuts[i])
                    counts[i] = n
        return total + sum(counts)

    def count(self, text: str) -> int:
        if not any(s in text for s in self.special):
            return self._count_plain(text)
        parts = self.cut_special.split(text)
        return sum(map(self._count_plain, parts)) + len(parts) - 1


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def public_path(name: str) -> str:
    """Where this machine has a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def digest(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024, locate=public_path) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, whole texts.

    A null text is empty: no bytes, no tokens. Special strings inside a text count as one token each,
    as the tokenizer's library has it. Repeated rows are counted each; other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(locate(tokenizer))
        for batch in batches:
            tokens = [counter.count(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    sized = docs.selectExpr("cast(doc_id as bigint) doc_id", "text", "cast(coalesce(octet_length(text), 0) as bigint) n_bytes")
    counted = sized.mapInArrow(scan, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.selectExpr("doc_id", "n_bytes", "n_tokens", f"n_tokens > {int(limit)} AS over_limit")
