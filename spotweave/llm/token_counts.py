"""Token counts by offset-mapped attribution.

A whole document is encoded once by a byte-level tokenizer whose tokens cover
the text without gaps, so running byte lengths of the ids are the tokens'
offsets.  The token spans are interval-joined to the spans of the document's
sections (both sorted: one binary search a token), and tokens that cross a
boundary are given to a section by an explicit rule:

* ``start``: the section that holds the token's first byte;
* ``end``: the section that holds its last byte;
* ``most``: the section that holds most of its bytes, the first one on a tie.

Sections are lines, a line end belonging to the line it ends.

Edge cases: null or empty text has one empty section without tokens; repeated
rows are counted once each; very long texts are encoded whole; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spotweave.llm import text as tx

RULES = ("start", "end", "most")
SCHEMA = "doc_id long, section int, start long, stop long, tokens long, crossing long, doc_tokens long"
_open: dict[str, tuple] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenizer(path: str):
    """(encoding, bytes of each id) for a rank file."""
    if path not in _open:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            size[i] = len(token)
        _open[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), size
    return _open[path]


def line_bounds(data: bytes) -> np.ndarray:
    """Byte offsets at which sections begin, and the end."""
    at = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return np.concatenate(([0], at[at < len(data)], [len(data)]))


def attribute(sizes: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens that cross the section's end) of each section, from the tokens' byte lengths."""
    sections = len(bounds) - 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.searchsorted(bounds[1:-1], starts, "right")
    last = np.searchsorted(bounds[1:-1], ends - 1, "right")
    crossing = last > first
    owner = last if rule == "end" else first.copy()
    if rule == "most":
        for t in np.flatnonzero(crossing):
            own = np.arange(first[t], last[t] + 1)
            held = np.minimum(bounds[own + 1], ends[t]) - np.maximum(bounds[own], starts[t])
            owner[t] = own[held.argmax()]
    return np.bincount(owner, minlength=sections), np.bincount(first[crossing], minlength=sections)


def section_tokens(docs: DataFrame, path: str | None = None, rule: str = "start") -> DataFrame:
    """One row a section: (doc_id, section, start, stop, tokens, crossing, doc_tokens); start and stop in code points."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    path = path or default_tokenizer()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = [pa.int32() if n == "section" else pa.int64() for n in names]

    def make(batches):
        enc, size = tokenizer(path)
        for batch in tx.text_slices(batches, "text", 1 << 20):
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = t.encode()
                ids = np.asarray(enc.encode_to_numpy(t, disallowed_special=())).astype(np.int64)
                bounds = line_bounds(data)
                counts, crossing = attribute(size[ids], bounds, rule)
                chars = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))[bounds]
                n = len(counts)
                row = (np.full(n, d), np.arange(n), chars[:-1], chars[1:], counts, crossing, np.full(n, len(ids)))
                for c, x in zip(cols, row, strict=True):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).tolist() if k == 0 else np.concatenate(c), kinds[k]) for k, c in enumerate(cols)], names)

    return docs.select("doc_id", "text").mapInArrow(make, SCHEMA)
