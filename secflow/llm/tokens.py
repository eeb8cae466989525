"""Token counts: lengths only, from batches balanced by bytes.

The vocabulary is applied by its own library. For a byte-level vocabulary a text is first cut into
units that its pre-tokenizer never joins: a cut lies before a single blank that stands between two
characters which are not white space, or before a line break of that kind. Words repeat, so each
worker keeps the lengths of the units it has met, up to a bound, and the library sees only new ones,
those of a batch as one text. Other vocabularies get whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import per_process

#: Units kept by a worker, in two halves: when the newer is full, it takes the place of the older.
KEPT_UNITS = 300_000
#: Bytes of text that are handled together; a longer text is cut at safe boundaries.
BATCH_BYTES = 4_000_000

# White space of Python's \s besides blank and line break; a superset of Unicode's property.
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_LETTERS = frozenset(map(chr, [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))


def regular(text: str) -> bool:
    """White space is single blanks and line breaks between other characters."""
    return not (
        "  " in text or " \n" in text or "\n " in text or "\n\n" in text or not text
        or text[0].isspace() or text[-1].isspace() or _RARE_SPACE.search(text))


def safe_pieces(text: str, limit: int) -> Iterator[str]:
    """Cut a long text before blanks between two other characters, as soon as ``limit`` is reached."""
    start = 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class Vocabulary:
    """A vocabulary file and the units met so far: their token counts, or their ids as bytes."""

    def __init__(self, path: str, ids: bool = False, kept: int = KEPT_UNITS):
        self.ids, self.kept = ids, kept
        self.after_blank: dict = {}  # unit without its leading blank, or with its leading line break
        self.plain: dict = {}
        self.before: dict = {}  # by lead: the units met before the last time that a dictionary was full
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.by_units = False
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.pieces = None
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        pre = parts.get("pre_tokenizer") or {}
        self.by_units = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and parts.get("normalizer") is None and parts["model"]["type"] == "BPE"
            and not parts["model"].get("ignore_merges")
            and not any(
                t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                for t in parts["added_tokens"]))
        if self.by_units:
            self.stops = dict(zip(",.", self._raw([",", "."]), strict=True))
            # ids that begin with a blank or line break, as byte-level vocabularies spell them
            names = self.tokenizer.get_vocab(with_added_tokens=False)
            self.leads = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
            self.leads[[k for name, k in names.items() if name[0] in "\u0120\u010a"]] = True

    def _raw(self, texts: list[str]) -> list:
        if self.pieces is not None:
            found = self.pieces.encode(texts, num_threads=1) if texts else []
        else:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(x, "<u4").tobytes() if self.ids else len(x) for x in found]

    def _units(self, units: list[str]) -> list:
        """As ``_raw`` of units that begin with a blank or line break, from one call over all of them."""
        found = self.tokenizer.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids if units else []
        ids = np.array(found, "<u4")
        starts = np.flatnonzero(self.leads[ids])
        if len(starts) != len(units):
            return self._raw(units)
        bounds = [*starts.tolist(), len(ids)]
        if not self.ids:
            return np.diff(bounds).tolist()
        whole = ids.tobytes()
        return [whole[4 * a:4 * b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def _learn(self, known: dict, new: set, lead: str) -> None:
        """Put units that ``known`` lacks into it; ``lead`` stands before each unit that has no line break."""
        before = self.before.setdefault(lead, {})
        if len(known) + len(new) > self.kept // 2:
            before.clear()
            before.update(known)
            known.clear()
        again = new.intersection(before)
        known.update(zip(again, map(before.__getitem__, again), strict=True))
        new = new - again
        # a full stop or comma after a letter is a piece of its own
        split = {u: u[:-1] for u in new if u[-1:] in self.stops and u[-2:-1] in _LETTERS and len(u) < 200}
        ask = list({split.get(u, u) for u in new}.difference(known))
        led = [u if u[0] == "\n" else lead + u for u in ask]
        known.update(zip(ask, self._units(led) if lead else self._raw(led), strict=True))
        for u, word in split.items():
            known[u] = known[word] + self.stops[u[-1]]

    def _values(self, known: dict, lists: dict, lead: str) -> dict:
        """What ``known`` has for the units of each list, after learning those that it lacks."""
        out = {k: list(map(known.get, units)) for k, units in lists.items()}
        lacking = [k for k, values in out.items() if None in values]
        if lacking:
            self._learn(known, {u for k in lacking for u, v in zip(lists[k], out[k], strict=True) if v is None}, lead)
            for k in lacking:
                # units that were known until the dictionary was full stand in the list already
                out[k] = [known[u] if v is None else v for u, v in zip(lists[k], out[k], strict=True)]
        return out

    def _join(self, values) -> int | bytes:
        return b"".join(values) if self.ids else sum(values)

    def encode(self, texts: list[str]) -> list:
        """Per text its token count, or its ids as little-endian unsigned 32-bit integers."""
        if not self.by_units:
            return self._raw(texts)
        firsts, rests, odd = {}, {}, {}
        for k, text in enumerate(texts):
            if regular(text):
                firsts[k], *rests[k] = text.replace("\n", " \n").split(" ")
            elif text:
                odd[k] = _CUT.split(text)
        after = self._values(self.after_blank, rests, " ")
        plain = self._values(self.plain, {k: [u] for k, u in firsts.items()} | odd, "")
        out: list = [b"" if self.ids else 0] * len(texts)
        for k, values in plain.items():
            out[k] = self._join((*values, *after.get(k, ())))
        return out

    def encode_all(self, texts: list[str | None], batch: int = BATCH_BYTES) -> list:
        """As ``encode``, in batches of about ``batch`` characters; null is the empty text."""
        out: list = [b"" if self.ids else 0] * len(texts)
        group: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            for (k, _), value in zip(group, self.encode([t for _, t in group]), strict=True):
                out[k] = out[k] + value
            group.clear()

        for k, text in enumerate(texts):
            for piece in safe_pieces(text or "", batch) if self.by_units else (text or "",):
                if size + len(piece) > batch and group:
                    flush()
                    size = 0
                group.append((k, piece))
                size += len(piece)
        flush()
        return out


def vocabulary(path: str, ids: bool = False) -> Vocabulary:
    return per_process(("vocabulary", path, ids), lambda: Vocabulary(path, ids))


def token_counts(docs: DataFrame, path: str, limit: int = 1024, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text, without begin or end tokens.

    A null text counts as the empty one: 0 bytes, 0 tokens. A null id stays null; repeated rows are
    counted row by row; other columns are ignored.
    """

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            texts = batch.column(1)
            counts = pa.array(known.encode_all(texts.to_pylist()), pa.int64())
            sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, counts, pc.greater(counts, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lengths, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
