"""Token counts under a public tokenizer, read from a file whose path is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from clipstrata.session import bounded_batches

#: Fixed value: the pieces the byte-level vocabulary was made for.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Text is given to the tokenizer in pieces of about this many characters, cut before a space that follows a letter, where
#: the pattern always cuts; the count is the same and a very long text needs no more memory than a short one.
PIECE = 1 << 16


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1 : cut + 2].isalpha()):
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def count(text: str | None, path: str = DEFAULT) -> int:
    if not text:
        return 0
    enc = encoding(path)
    return sum(len(enc.encode_ordinary(p)) for p in _pieces(text))


def with_tokens(df: DataFrame, text: str, out: str = "n_tokens", *, path: str = DEFAULT) -> DataFrame:
    """Adds the number of tokens; 0 for null and empty texts. The text itself is dropped, so it is never shuffled."""
    bounded_batches(df.sparkSession)
    rest = [f for f in df.schema if f.name != text]
    df = df.select(*[df[f.name] for f in rest], df[text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = pa.array([count(t, path) for t in b.column(len(rest)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(rest)], n], names=[*[f.name for f in rest], out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return df.mapInArrow(run, f"{schema}, `{out}` long")
