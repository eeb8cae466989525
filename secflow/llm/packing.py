"""Best-fit packing: documents into sequences of a fixed number of tokens, by hierarchical residual rounds.

Texts are encoded once; what later steps move is one narrow row per piece (its place in the document,
its length and a checksum of its ids). A round deals the open bins to partitions by a hash of the bin,
so that every partition sees a sample of all lengths whatever the order of the input, and packs its
bins into larger ones by best fit, largest first. Bins that are full but for ``NEARLY`` tokens leave;
the others are the items of the next round, in an eighth of the partitions, until one partition is
left or fewer would hold more than ``TASK_ROWS`` rows. A bin is named by its first piece.
"""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.llm.common import per_process, stored

CAPACITY = 4096
END_ID = 1
#: A bin with at most so many free tokens is left as it is.
NEARLY = 8
#: Rows of a task of the packing rounds, and how many partitions merge into one after a round.
TASK_ROWS = 1 << 18
FAN = 8
#: Units and parts whose ids a worker keeps, the longest unit kept, and characters handled together.
KEPT_UNITS = 300_000
KEPT_PARTS = 800_000
KEPT_LENGTH = 24
BATCH_CHARS = 4_000_000

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECE}, bin long, offset long, filled long"

# The pre-tokenizer's pattern for lower-case text of ASCII and Latin-1 letters, which fall into its letter class; line
# breaks, which no unit holds, stand apart.
_PARTS = re.compile(r"\n|'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[\x00-\x7FÀ-ÖØ-öø-ÿ]+")
# Fixed value: the pattern of a vocabulary file whose words may be encoded one by one.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BREAK = b"\xff\xff\xff\xff"  # no id of a vocabulary


def _by_words(parts: dict) -> bool:
    """White space is dropped and nothing else crosses it, so that words can be encoded apart."""
    pre = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
    normal = [(x["type"], x.get("content")) for x in (parts.get("normalizer") or {}).get("normalizers", [])]
    return (
        normal == [("NFC", None), ("Replace", " "), ("Lowercase", None)] and len(pre) == 2
        and pre[0]["type"] == "Split" and pre[0]["pattern"] == {"Regex": _SPLIT} and pre[0]["behavior"] == "Removed"
        and pre[0]["invert"] and pre[1]["type"] == "ByteLevel" and not pre[1]["add_prefix_space"]
        and not pre[1]["use_regex"] and parts.get("post_processor") is None
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])
                    for t in parts["added_tokens"]))


def _byte_letters() -> dict[int, str]:
    """Latin-1 letters as a byte-level vocabulary spells their UTF-8 bytes: printable bytes stand for themselves,
    the others for the characters from U+0100 on."""
    shown = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    hidden = [b for b in range(256) if b not in shown]
    spelt = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return {c: "".join(spelt[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class WordIds:
    """Ids of texts as little-endian unsigned 32-bit integers.

    Words repeat, so the ids of units (runs without white space) are kept, up to a bound. New units are
    divided into parts (letters, a digit or marks), and the library's model sees new parts only, all of a
    batch in one call. Units with other letters than Latin-1's go to the whole library.
    """

    def __init__(self, path: str, kept: int = KEPT_UNITS, kept_parts: int = KEPT_PARTS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.words = _by_words(parts)
        if not self.words:
            return
        self.special = [t["content"] for t in parts["added_tokens"]]
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        suffix = parts["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(self.library.get_vocab().values()) + 1, bool)
        self.ends[[k for word, k in parts["model"]["vocab"].items() if word.endswith(suffix)]] = True
        self.kept, self.kept_parts = kept, kept_parts
        self.units: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {"\n": _BREAK}

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        """Ids of each part, from one call of the model: a part's last token ends a word."""
        text = " ".join(parts)
        spelt = text if text.isascii() else text.translate(self.letters)
        ids = np.array(self.model.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
        stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(stops) != len(parts) or not text.isprintable():
            return self._raw(parts)
        whole = ids.tobytes()
        return [whole[a:b] for a, b in zip([0, *stops.tolist()], stops.tolist(), strict=False)]

    def _learn(self, units: set[str]) -> None:
        new = units.difference(self.units)
        odd = {u for u in new if not u.isascii() and not _PLAIN.fullmatch(u) or "<|" in u and any(s in u for s in self.special)}
        plain = list(new - odd)
        divided = _PARTS.findall("\n".join(plain).lower())
        ask = list(set(divided).difference(self.parts))
        if len(self.parts) + len(ask) > self.kept_parts:
            self.parts = {"\n": _BREAK}
            ask = list(set(divided).difference(self.parts))
        if ask:
            self.parts.update(zip(ask, self._part_ids(ask), strict=True))
        joined = b"".join(map(self.parts.__getitem__, divided))
        stops = [*(4 * np.flatnonzero(np.frombuffer(joined, "<u4") == 0xFFFFFFFF)).tolist(), len(joined)]
        self.units.update(zip(
            plain, [joined[a:b] for a, b in zip([0, *[k + 4 for k in stops]], stops, strict=False)], strict=True)
            if plain else ())
        self.units.update(zip(odd, self._raw(list(odd)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.words:
            return self._raw(texts)
        # str.split() also divides at four separators that are not white space for the library
        whole = [k for k, t in enumerate(texts) if any(c in t for c in "\x1c\x1d\x1e\x1f")]
        divided = [t.split() for t in texts]
        for k in whole:
            divided[k] = []
        units: set[str] = set().union(*divided)
        self._learn(units)
        out = [b"".join(map(self.units.__getitem__, x)) for x in divided]
        for k, ids in zip(whole, self._raw([texts[k] for k in whole]), strict=True):
            out[k] = ids
        if len(self.units) > self.kept:  # words that are met often are in this batch too
            self.units = {u: self.units[u] for u in units if len(u) <= KEPT_LENGTH}
        return out


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every document's ids, cut at each ``capacity`` tokens."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_process(("word ids", path), lambda: WordIds(path))
        for batch in batches:
            rows: list[tuple] = []
            doc_ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                upto, size = at + 1, len(texts[at])
                while upto < len(texts) and size + len(texts[upto]) <= BATCH_CHARS:
                    size += len(texts[upto])
                    upto += 1
                for doc_id, ids in zip(doc_ids[at:upto], known.encode(texts[at:upto]), strict=True):
                    ids += end
                    for k, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start:start + 4 * capacity]
                        rows.append((doc_id, k, start // 4, len(part) // 4, zlib.crc32(part)))
                at = upto
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows) if rows else [[]] * 5, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()],
                    strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, _PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item: its bin (an item's index), its offset there, and the bin's size when all are placed.

    Items come largest first, equal ones in their order, and go to the open bin they fill most.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled = np.zeros(len(sizes), np.int64)
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r stands for an open bin with r tokens of room
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            same = by_room[room]
            home = same.pop()
            if not same:
                rooms ^= 1 << room
        else:
            room, home = capacity, item
        bins[item], offsets[item] = home, capacity - room
        room -= size
        filled[home] = capacity - room
        if room:
            if not by_room.setdefault(room, []):
                rooms |= 1 << room
            by_room[room].append(home)
    return bins, offsets, filled[bins]


def _round(placed: DataFrame, partitions: int, capacity: int) -> DataFrame:
    """Pack the bins of each partition into larger ones; a bin's rows are always together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.Table.from_batches(tables)
        held, offset, filled = (rows.column(c).to_numpy() for c in ("bin", "offset", "filled"))
        names, first, member = np.unique(held, return_index=True, return_inverse=True)
        bins, starts, sizes = best_fit(filled[first], capacity)
        placed = {"bin": names[bins][member], "offset": starts[member] + offset, "filled": sizes[member]}
        for name, values in placed.items():
            rows = rows.set_column(rows.column_names.index(name), name, pa.array(values, pa.int64()))
        yield from rows.combine_chunks().to_batches(max_chunksize=100_000)

    return placed.repartition(partitions, F.xxhash64("bin")).mapInArrow(pack, _PLACED)


def packed(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, nearly: int = NEARLY,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    Only documents of more than ``capacity`` tokens are cut, whatever their length; their pieces share no
    order of sequences. A null or empty text is the end token alone, a null id stays null, repeated rows
    are packed one by one, ties go to the earlier row, other columns are ignored; no rows give no rows.
    Rows of equal content may swap places between runs.
    """
    cut = pieces(docs, path, capacity, end_id).withColumn("bin", F.monotonically_increasing_id())
    placed = stored(
        cut.select("*", F.lit(0).cast("long").alias("offset"), F.col("length").alias("filled")), "pieces")
    is_open = F.col("filled") < capacity - nearly
    done = [placed.where(~is_open)]
    rows = placed.where(is_open).count()
    partitions = math.ceil(rows / task_rows)
    while rows:
        placed = stored(_round(placed.where(is_open), partitions, capacity), "packed")
        rows = placed.where(is_open).count()
        fewer = max(math.ceil(partitions / FAN), math.ceil(rows / task_rows))
        last = fewer >= partitions
        done.append(placed if last else placed.where(~is_open))
        if last:
            break
        partitions = fewer
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
