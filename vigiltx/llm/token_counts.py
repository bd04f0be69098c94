"""Token counts of sections: each text is encoded once, and its tokens are then given to sections by their places."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from vigiltx.llm.common import carried, ship, uncarried

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
ADDED = ["n_tokens", "n_sections", "n_crossing", "section_tokens"]
RULES = ("first", "last", "most")
_encoders: dict[str, tuple] = {}


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoder(content: bytes):
    """The encoding, and the bytes of each of its tokens; made once in each worker."""
    import tiktoken
    from public_tokenizers import PATTERN

    key = str(hash(content))
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        _encoders[key] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes
    return _encoders[key]


def offsets(text: str, encoding, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last character of each token; a token that ends inside a character covers it."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    ends = np.cumsum(sizes[encoding.encode_to_numpy(text, disallowed_special=())].astype(np.int64)) if text else np.empty(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
    if len(raw) == len(text):
        return starts, ends
    place = np.cumsum((raw & 0xC0) != 0x80) - 1  # the character that a byte belongs to
    return place[starts], place[ends - 1] + 1


def lines(text: str) -> np.ndarray:
    """Where the sections of a text begin: its lines, each with the line feed that ends it."""
    at = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10) + 1
    return np.concatenate([[0], at[at < len(text)]]).astype(np.int64) if text else np.empty(0, np.int64)


def attributed(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, length: int, rule: str) -> tuple[np.ndarray, int]:
    """Tokens of each section, and how many tokens cross a boundary: an interval join of two sorted lists."""
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.searchsorted(sections, ends - 1, "right") - 1
    crossing = first != last
    to = first.copy() if rule != "last" else last
    if rule == "most":
        edges = np.append(sections, length)
        for t in np.flatnonzero(crossing):
            cover = [min(ends[t], edges[s + 1]) - max(starts[t], edges[s]) for s in range(first[t], last[t] + 1)]
            to[t] = first[t] + int(np.argmax(cover))
    return np.bincount(to, minlength=len(sections)), int(crossing.sum())


def count_tokens(docs: DataFrame, *, text: str = "text", rule: str = "first", path: str = VOCABULARY) -> DataFrame:
    """``docs`` with the tokens of each section (line) of a text, and their sums.

    A text is encoded once as a whole, never line by line, so ``n_tokens`` is what the whole text costs. A token that
    covers characters of several sections goes to the one of its first character (``rule`` "first"), of its last
    character ("last"), or to that with most of its characters, the earliest in a tie ("most"); so the sections of a
    text always add up to its tokens. ``n_crossing`` counts such tokens. A null or empty text has no section and no
    token; the names of special tokens are ordinary text. Input columns named as an output are replaced.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    @pandas_udf("n_tokens long, n_sections long, n_crossing long, section_tokens array<long>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoding, sizes = encoder(shared.value)
        for batch in batches:
            rows = []
            for t in batch:
                t = t or ""
                starts, ends = offsets(t, encoding, sizes)
                cuts = lines(t)
                each, crossing = attributed(starts, ends, cuts, len(t), rule)
                rows.append((len(starts), len(cuts), crossing, each))
            yield pd.DataFrame(rows, columns=ADDED)

    found = carried(docs, F.col(text).cast("string").alias("_text")).withColumn("_found", counted("_text"))
    return uncarried(found, docs.columns, *(F.col("_found")[c].alias(c) for c in ADDED), added=ADDED)
