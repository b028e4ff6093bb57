"""Token counts of whole texts with a subword model, without merging most of the words.

A text falls into segments that no merge can cross: a run of spaces with the
characters after it, and every line break alone. Segments that the vocabulary
encodes alone as one token are counted directly; only the rest is merged.
"""

from __future__ import annotations

import re
from collections import Counter

import sentencepiece
from pyspark.sql import DataFrame

from barloom.llm.base import map_batches, prepared, small_groups

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
SPACE = "▁"
GENERAL = re.compile(r" +[^ \n]*|[^ \n]+|\n")
# Distinct segments remembered by one Python worker; beyond it the memory starts anew.
REMEMBERED = 500_000


class SegmentCounter:
    """Numbers of tokens of segments; merges in one call what a batch meets for the first time.

    Built from the bytes of a model whose pieces never hold a space after another
    character and never hold a line break next to one; anything else is refused,
    because segments would then not be independent.
    """

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [
            self.processor.id_to_piece(i).replace(SPACE, " ")
            for i in range(self.processor.get_piece_size())
            if not (
                self.processor.is_control(i)
                or self.processor.is_unknown(i)
                or self.processor.is_byte(i)
            )
        ]
        crossing = [p for p in pieces if re.search(r"[^ ] ", p) or ("\n" in p and p != "\n")]
        if crossing:
            raise ValueError(f"pieces cross segments, for instance {crossing[0]!r}")
        # the proof: which pieces come out of the merges as one token when alone
        alone = zip(pieces, self.merged(pieces), strict=True)
        self.whole = {piece: 1 for piece, n in alone if n == 1}
        self.whole |= {"": 0, "\n": self.merged(["\n"])[0]}
        self.known = dict(self.whole)

    def merged(self, segments: list[str]) -> list[int]:
        """Tokens of each segment by the model's own merges.

        The model puts one space in front of what it gets. It stands for a segment's
        own first space; before other segments a line break keeps it apart.
        """
        apart = len(self.processor.encode("\n", num_threads=1))
        spaced = [len(s) > 1 and s[0] == " " for s in segments]
        given = [s[1:] if own else "\n" + s for s, own in zip(segments, spaced, strict=True)]
        ids = self.processor.encode(given, num_threads=1)
        return [len(x) - (0 if own else apart) for x, own in zip(ids, spaced, strict=True)]

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each whole text."""
        found = [Counter(segments(t or "")) for t in texts]
        known = self.known
        new = list({s for segs in found for s in segs if s not in known})
        counts = dict(zip(new, self.merged(new), strict=True)) if new else {}
        if len(known) + len(new) > REMEMBERED:
            # what this batch needs from the memory that is given up
            counts |= {s: known[s] for segs in found for s in segs if s in known}
            known = self.known = dict(self.whole)
        known |= counts
        return [sum([n * known[s] for s, n in segs.items()]) for segs in found]


def segments(text: str) -> list[str]:
    """The text's segments in order, with the space that the model puts in front; some may be ''."""
    if not text:
        return []
    text = " " + text.replace(SPACE, " ")
    if "  " in text or "\0" in text:
        return GENERAL.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")


_counters: dict[bytes, SegmentCounter] = {}


def token_counts(documents: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, UTF-8 bytes, tokens and whether they exceed `limit`, one row per input row.

    A NULL text counts as empty: 0 bytes, 0 tokens, not over the limit. A NULL
    doc_id stays NULL, repeated rows give repeated rows, other columns are ignored,
    an empty table gives no rows. Texts are counted whole, however long.
    """
    spark = prepared(documents.sparkSession)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())  # one vocabulary file, about 0.5 MB

    def count(columns: dict[str, list]) -> dict[str, list]:
        counter = _counters.get(model.value)
        if counter is None:
            counter = _counters[model.value] = SegmentCounter(model.value)
        texts = [t or "" for t in columns["text"]]
        tokens = [n for group in small_groups(texts) for n in counter.count(group)]
        return {
            "doc_id": columns["doc_id"],
            "n_bytes": [len(t) if t.isascii() else len(t.encode()) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    return map_batches(documents.select("doc_id", "text"), count, SCHEMA)
