"""Token counts of whole texts without running a tokenizer on most of them.

A vocabulary string that the tokenizer encodes alone as one token needs no merges.
The set of these is proved once, by encoding every vocabulary string. Texts are
cut into pre-tokens by the tokenizer's own pattern; a pre-token in the set counts
one, any other is merged by the library and remembered.

Cutting is done here only for texts of characters below `PLAIN_END` without the
strings of special tokens: there composition changes nothing, and case, letters,
numbers and spaces are checked one character at a time against the library
(`proved`). Any other text is given to the library whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

PLAIN_END = 0x300
REMEMBERED = 400_000
BATCH_ROWS = 256
TOKEN_LIMIT = 2048


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern(tokenizer_json: str) -> str:
    parts = json.loads(tokenizer_json)["pre_tokenizer"]["pretokenizers"]
    return parts[0]["pattern"]["Regex"]


def _plain_text(text: str) -> str:
    # Below PLAIN_END no character composes with the next and lower case needs no context.
    return text.lower()


def single_tokens(tokenizer: Tokenizer, pattern: str) -> frozenset[str]:
    """The pre-tokens that are one token by themselves, each one tried."""
    candidates = set()
    # The byte-level alphabet: the visible bytes stand for themselves, the others follow from 256.
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in set(visible)]
    decoder = {chr(byte): byte for byte in visible} | {chr(256 + k): byte for k, byte in enumerate(hidden)}
    for string in tokenizer.get_vocab(with_added_tokens=False):
        whole = string.removesuffix("</w>")
        try:
            text = bytes(decoder[c] for c in whole).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        if string.endswith("</w>") and regex.fullmatch(pattern, text):
            candidates.add(text)
    listed = sorted(candidates)
    encoded = tokenizer.encode_batch(listed, add_special_tokens=False)
    return frozenset(text for text, e in zip(listed, encoded) if len(e.ids) == 1)


def proved(tokenizer: Tokenizer, pattern: str) -> bool:
    """Whether each plain character, alone and between letters, is cut here as the library cuts it."""
    for code in range(PLAIN_END):
        for text in (chr(code), f"a{chr(code)}b", f"1{chr(code)}{chr(code)}!"):
            theirs = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))
            ours = regex.findall(pattern, _plain_text(text))
            if [len(piece.encode()) for piece in ours] != [len(piece) for piece, _ in theirs]:
                return False
    return True


class _Counts:
    """Tokens per pre-token; unknown ones are merged by the library, many at once."""

    def __init__(self, known, tokenizer):
        self.known, self.tokenizer = known, tokenizer
        self.counts = dict.fromkeys(known, 1)

    def sums(self, texts: list[list[str]]) -> list[int]:
        if len(self.counts) > len(self.known) + REMEMBERED:
            self.counts = dict.fromkeys(self.known, 1)
        missing = list(set().union(*texts).difference(self.counts))
        merged = self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)
        self.counts.update(zip(missing, (len(e.ids) for e in merged)))
        get = self.counts.__getitem__
        return [sum(map(get, pieces)) for pieces in texts]


_LOADED: dict[int, tuple] = {}
# Tasks share the machine; each merges in its own thread.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def _loaded(tokenizer_json: str, known: frozenset[str]):
    key = hash(tokenizer_json)
    if key not in _LOADED:
        tokenizer = Tokenizer.from_str(tokenizer_json)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        special = "|".join(regex.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values())
        other = regex.compile(f"[^\\x00-{chr(PLAIN_END - 1)}]" + (f"|{special}" if special else ""))
        _LOADED[key] = tokenizer, regex.compile(_pattern(tokenizer_json)), other, _Counts(known, tokenizer)
    return _LOADED[key]


def count_tokens(texts, tokenizer_json: str, known: frozenset[str], plain: bool = True) -> list[int]:
    tokenizer, pattern, other, counts = _loaded(tokenizer_json, known)
    cut = [None if not plain or other.search(text) else pattern.findall(_plain_text(text)) for text in texts]
    sums = iter(counts.sums([pieces for pieces in cut if pieces is not None]))
    return [
        len(tokenizer.encode(text, add_special_tokens=False).ids) if pieces is None else next(sums)
        for text, pieces in zip(texts, cut)
    ]


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = TOKEN_LIMIT
) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `n_bytes`, `n_tokens`, `over_limit`.

    Begin, end and other added special tokens are not added; their strings in a
    text are handled as the library does by default. A NULL or empty text has
    no tokens. Other columns are not looked at.
    """
    with open(path or tokenizer_path(), encoding="utf-8") as file:
        tokenizer_json = file.read()
    tokenizer = Tokenizer.from_str(tokenizer_json)
    pattern = _pattern(tokenizer_json)
    # Both have the size of the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, single_tokens(tokenizer, pattern)))
    plain = proved(tokenizer, pattern)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                numbers = count_tokens(part.column(2).to_pylist(), *shared.value, plain)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(numbers, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
