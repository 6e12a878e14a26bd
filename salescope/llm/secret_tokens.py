"""Secret scan: fixed patterns, and runs that a public tokenizer finds hard to compress.

A byte-pair vocabulary spends few tokens on words and many on random strings. Runs of
key characters with few characters per token are reported, with letters, digits or both,
unless they are known digests (hexadecimal of a usual length), UUIDs, or identifiers and
paths made of numbers and of words that the vocabulary knows: a word of several letters
needs enough characters per token itself.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.textops import slim

KINDS = ("assign", "access", "hex", "dense")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
# A maximal run of the class, so the lower bound may stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE = 12

RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KNOWN_DIGEST = re.compile(r"[0-9a-fA-F]+\Z")
DIGEST_LENGTHS = frozenset({32, 40, 48, 56, 64, 96, 128})
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
# Pieces of an identifier: words with an optional number, or numbers. Separators are
# taken possessively, so a long row of them cannot be split in many ways.
IDENTIFIER = re.compile(
    r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,4}|\d+)(?:[_/+=-]++(?:(?:[A-Z]?[a-z]+|[A-Z]+)\d{0,4}|\d+)?)*\Z"
)
# What of an identifier may be random: letters beyond the shortest words, long numbers.
JUDGED = re.compile(r"[A-Za-z]{4,}|\d{20,}")
CHARACTERS_PER_TOKEN = 2.2
# The tokenizer's work grows with the square of a piece: longer runs are cut.
PIECE = 512


def load_encoder(path: str) -> Callable[[str], int]:
    """The number of tokens of a text under the vocabulary at ``path`` (rank file)."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    encoding = tiktoken.Encoding("scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda run: sum(len(encoding.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE))


def is_known(run: str, tokens: Callable[[str], int], ratio: float = CHARACTERS_PER_TOKEN) -> bool:
    """A digest of a usual length, a UUID, a rule of signs, or an identifier made of
    numbers and words that the vocabulary knows."""
    if not any(c.isalnum() for c in run) or UUID.match(run):
        return True
    # A row of digits alone is judged by its tokens, like a row of letters.
    if KNOWN_DIGEST.match(run) and len(run) in DIGEST_LENGTHS and not run.isdigit():
        return True
    if not IDENTIFIER.match(run):
        return False
    return all(len(piece) >= ratio * tokens(piece) for piece in JUDGED.findall(run))


def scan(text: str, tokens: Callable[[str], int], ratio: float = CHARACTERS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Spans (start, kind index, end) in code points, ordered by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in RUN.finditer(text):
        run = m.group()
        if len(run) < ratio * tokens(run) and not is_known(run, tokens, ratio):
            found.append((m.start(), 3, m.end()))
    found.sort()
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_dense long"
)


def find_secrets(docs: DataFrame, vocabulary: str | None = None, ratio: float = CHARACTERS_PER_TOKEN) -> DataFrame:
    """One row per document with its base and dense spans.

    A null or empty text has no span (the digest of the empty string). Ids may repeat
    or be null; each row is scanned by itself. The pass is map-only.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load_encoder(vocabulary)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                spans = scan(text or "", tokens, ratio)
                base = _joined([s for s in spans if s[1] < 3])
                count = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
                rows.append((*count[:3], hashlib.sha256(base.encode()).hexdigest(), _joined(spans), count[3]))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    rows = slim(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(run, SCHEMA)
