"""Operator 3: packing token streams into fixed windows by minimum bin slack.

A document is tokenized whole, closed with an end id, and cut into full
windows plus one tail. A full window stays where it was written. Tails are
dealt out into cells of a bounded number of ids, by one exchange, and a cell is
packed in one task: what is to be decided depends on nothing but how many tails
of each length there are, at most ``window`` numbers. The longest remaining
length opens a window; a bitset subset-sum over the remaining lengths, each
with its count, finds the multiset that fills the window closest to capacity;
backtracking through the bitsets gives the counts, and the window is repeated
as often as all its lengths last. So each step uses up a length and a cell's
plan has at most ``window`` patterns.

Where no multiset fills a window to the brim, the lengths concerned go to a
remainder stream which is cut every ``window`` ids; a cell's last, partial
window is cut into powers of two, which need no padding.

Ids are kept in 16 bits where the vocabulary fits. The windows are written;
pieces, ids and checksums are read from there.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives no pieces; columns other than the id and
the text are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rivulet.llm.common import groups_for, materialize, once_per_process, read_table, slices, text_or_empty
from rivulet.session import scratch_path

WINDOW = 4096
END_ID = 2
#: Distinct words in each of the two generations a worker remembers.
CACHE_ENTRIES = 100_000
#: Text whose words are told apart at once.
SLICE_BYTES = 4 << 20
#: Ids of the tails that one task packs.
CELL_IDS = 16 << 20
#: Windows whose pieces are cut out at once.
READ_ROWS = 512
#: Letters of which a run is one pre-token that lower case and NFC keep whole,
#: then marks (no apostrophe, which may begin a contraction), also one pre-token.
#: Matched over words a line each: letters, marks, or any other word.
SIMPLE = r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)\n|([^\n]*)\n"


# ---------------------------------------------------------------- tokenizing

class WordTokens:
    """Ids of whole texts, word by word.

    The tokenizer drops white space and never joins across it, so the ids of
    a text are those of its white-space separated words one after the other
    (split at ASCII white space only; any other is left to the tokenizer).
    Words repeat, so a worker remembers them: those of the current generation
    and, once that is full, those of the one before.
    """

    def __init__(self, tokenizer_json: str):
        import re

        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_str(tokenizer_json)
        self.tk.encode_special_tokens = True   # their strings are ordinary text
        vocab = self.tk.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.merger = self._merger(json.loads(tokenizer_json))
        self.shapes = re.compile(SIMPLE).findall
        self.marks: dict[str, bytes] = {"": b""}
        self.young: dict[str, bytes] = {}        # words
        self.old: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}        # their letters

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tk.encode_batch_fast(texts, add_special_tokens=False)]

    def _merger(self, definition: dict):
        """The same merges as a rank encoder, which is faster for many short
        words: the line feed after a word stands for the end-of-word mark.
        None if the vocabulary is not in the order of its merges."""
        import tiktoken

        model = definition["model"]
        vocab, mark = model["vocab"], model.get("end_of_word_suffix") or ""
        made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        plain = [b for b in range(256) if chr(b).isprintable() and b not in (32, 0xAD)]
        char = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        byte = {c: b for b, c in char.items()}
        first = [vocab.get(c + e) for e in ("", mark) for c in char.values()]
        if not mark or None in made or None in first or made != sorted(made) or max(first) > min(made):
            return None
        ranks = {bytes(map(byte.get, t)): i for t, i in vocab.items() if not t.endswith(mark) and set(t) <= byte.keys()}
        ends = ((t.removesuffix(mark), i) for t, i in vocab.items() if t.endswith(mark))
        ranks |= {bytes(map(byte.get, t)) + b"\n": i for t, i in ends if set(t) <= byte.keys()}
        return tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={})

    def _letters(self, words: list[str], at_once: int = 4096) -> dict[str, bytes]:
        """Ids of words that are one pre-token each: many in one call, told
        apart by the tokens that end a word."""
        out: dict[str, bytes] = {}
        for i in range(0, len(words), at_once):
            part = words[i:i + at_once]
            if self.merger:
                ids = np.array(self.merger.encode_ordinary("\n".join(part).lower() + "\n"), "<u4")
            else:
                ids = np.array(self._batch([" ".join(part)])[0], "<u4")
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(part):
                data, ends = ids.tobytes(), (cuts * 4).tolist()
                out.update(zip(part, map(data.__getitem__, map(slice, [0, *ends], ends))))
            else:
                out.update((w, np.array(x, "<u4").tobytes()) for w, x in zip(part, self._batch(part)))
        return out

    def _learn(self, words: list[str]) -> None:
        old, cores, marks = self.old, self.cores, self.marks
        again = {w: old[w] for w in words if w in old}
        self.young.update(again)
        words = [w for w in words if w not in again]
        shapes = self.shapes("\n".join(words) + "\n") if words else []
        cores.update(self._letters([c for c in {c for c, _, _ in shapes} if c and c not in cores]))
        new = [t for t in {t for _, t, _ in shapes} if t not in marks]
        marks.update((t, np.array(i, "<u4").tobytes()) for t, i in zip(new, self._batch(new) if new else []))
        odd = [w for w, (c, _, _) in zip(words, shapes) if not c]
        self.young.update((w, np.array(i, "<u4").tobytes()) for w, i in zip(odd, self._batch(odd) if odd else []))
        self.young.update({w: cores[c] + marks[t] for w, (c, t, _) in zip(words, shapes) if c})

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text ends."""
        # lower case may come first only where no mark can combine with a letter
        lower = pa.compute.if_else(pa.compute.string_is_ascii(texts), pa.compute.ascii_lower(texts), texts)
        split = pa.compute.ascii_split_whitespace(lower)
        coded = split.flatten().dictionary_encode()
        if len(self.young) > CACHE_ENTRIES:
            self.old, self.young = self.young, {}
        for known in (self.cores, self.marks):
            if len(known) > CACHE_ENTRIES:
                known.clear()
                self.marks[""] = b""
        young, here = self.young, coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn([w for w in here if w not in young])
        # every word's ids, one word after the other, copied as bytes
        flat = pa.array([young[w] for w in here], pa.large_binary()).take(coded.indices)
        _, offsets, data = flat.buffers()
        until = np.frombuffer(offsets, np.int64, len(flat) + 1) // 4 if len(flat) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, "<u4", until[-1]) if until[-1] else np.empty(0, "<u4")
        return ids, until[split.offsets.to_numpy()[1:] - split.offsets[0].as_py()]


def id_width(tokenizer_json: str, end_id: int = END_ID) -> str:
    """Numpy type that holds every id."""
    model = json.loads(tokenizer_json)
    top = max([end_id, *model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens") or [])])
    return "<u2" if top < 1 << 16 else "<u4"


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, doc_tokens, ids): full windows and tails. ``ids``
    is of ``id_width``."""
    import os

    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    digest = hashlib.sha256(definition.encode()).hexdigest()
    width = np.dtype(id_width(definition, end_id))
    shared = df.sparkSession.sparkContext.broadcast(definition)
    last, step = np.array([end_id], width).tobytes(), width.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = once_per_process(f"words {digest}", lambda: WordTokens(shared.value))
        gc.disable()      # millions of small strings and no cycles; a worker ends with its executor
        for batch in batches:
            for part in slices(batch, "__text", SLICE_BYTES):
                row, start, length, total, ids = [], [], [], [], []
                flat, ends = words.encode(part.column(1))
                flat = flat.astype(width).tobytes()
                for i, (a, b) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                    data = flat[step * a:step * b] + last
                    n = len(data) // step
                    for a in range(0, n, window):
                        row.append(i), start.append(a), length.append(min(window, n - a)), total.append(n)
                        ids.append(data[step * a:step * (a + window)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(total, pa.int64()), pa.array(ids, pa.binary())],
                    ["id", "start", "length", "doc_tokens", "ids"])

    src = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("__text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, start long, length int, doc_tokens long, ids binary")


# ------------------------------------------------------------------ planning

def closest_fill(lengths: list[tuple[int, int]], room: int) -> tuple[int, dict[int, int]]:
    """The largest sum <= room of a sub-multiset of ``lengths`` ((length,
    count), descending), with the count of each length in it."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length, count in lengths:
        left = min(count, room // length)
        if not left:
            continue
        steps.append((length, reach))
        take = 1
        while left:                       # binary splitting of the count
            take = min(take, left)
            reach |= reach << take * length & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    best = at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, before in reversed(steps):
        while not before >> at & 1:
            at -= length
            used[length] = used.get(length, 0) + 1
    return best, used


@dataclass
class Plan:
    """Where the piece of a length and a rank goes.

    ``whole``: (length, first rank, per window, first sequence, offset) of the
    planned windows; ``stream``: (length, first rank, first position) of the
    remainder stream, which begins at sequence ``stream_seq``.
    """

    window: int
    whole: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    stream: list[tuple[int, int, int]] = field(default_factory=list)
    stream_seq: int = 0
    stream_len: int = 0

    def stream_cuts(self) -> list[int]:
        """Sequence borders within the last, partial window of the stream."""
        at = self.stream_len - self.stream_len % self.window
        cuts = [at]
        for bit in reversed(range(self.window.bit_length())):
            if (self.stream_len - at) >> bit & 1 and 1 << bit < self.window:
                cuts.append(cuts[-1] + (1 << bit))
        return cuts


def plan_windows(hist: dict[int, int], window: int = WINDOW, max_slack: int = 0) -> Plan:
    left = {n: c for n, c in hist.items() if c > 0}
    done = dict.fromkeys(left, 0)
    order = sorted(left, reverse=True)
    plan, seq, aside = Plan(window), 0, []
    while order:
        seed = order[0]
        left[seed] -= 1
        slack_of, used = closest_fill([(n, left[n]) for n in order if n <= window - seed and left[n]], window - seed)
        left[seed] += 1
        if window - seed - slack_of > max_slack:
            aside.append(seed)            # nothing fills it: to the stream
            order.pop(0)
            continue
        used[seed] = used.get(seed, 0) + 1
        times = min(left[n] // c for n, c in used.items())
        at = 0
        for n in sorted(used, reverse=True):
            plan.whole.append((n, done[n], used[n], seq, at))
            at += n * used[n]
            done[n] += times * used[n]
            left[n] -= times * used[n]
        seq += times
        order = [n for n in order if left[n]]
    at = 0
    for n in aside:
        if left[n]:
            plan.stream.append((n, done[n], at))
            at += n * left[n]
    plan.stream_seq, plan.stream_len = seq, at
    return plan


class Placer:
    """Plan lookups, vectorised over (length, rank)."""

    def __init__(self, plan: Plan):
        self.plan = plan
        whole = sorted(plan.whole)
        self.whole = np.array(whole, np.int64).reshape(-1, 5)
        self.by_length: dict[int, tuple[int, int]] = {}
        for i, (n, *_) in enumerate(whole):
            self.by_length[n] = (self.by_length.get(n, (i, i))[0], i + 1)
        self.stream = {n: (rank, at) for n, rank, at in plan.stream}
        self.cuts = plan.stream_cuts()
        self.last = plan.stream_len - plan.stream_len % plan.window

    def place(self, length: np.ndarray, rank: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, start in piece, length, sequence, offset) of every part."""
        for n in np.unique(length):
            rows = np.flatnonzero(length == n)
            r, (a, b) = rank[rows], self.by_length.get(int(n), (0, 0))
            first_stream = self.stream.get(int(n), (None, 0))[0]
            in_stream = r >= first_stream if first_stream is not None else np.zeros(len(r), bool)
            rules = self.whole[a:b]
            q = rows[~in_stream]
            if len(q):
                rr = rank[q]
                k = np.searchsorted(rules[:, 1], rr, "right") - 1
                x = rr - rules[k, 1]
                seq, at = rules[k, 3] + x // rules[k, 2], rules[k, 4] + x % rules[k, 2] * n
                yield from zip(q.tolist(), [0] * len(q), [int(n)] * len(q), seq.tolist(), at.tolist())
            for i in rows[in_stream].tolist():
                yield from self._stream_parts(i, int(n), int(rank[i]))

    def _stream_parts(self, row: int, n: int, rank: int) -> Iterator[tuple[int, int, int, int, int]]:
        first, base = self.stream[n]
        at = base + (rank - first) * n
        start, end, window = 0, at + n, self.plan.window
        while at < end:
            if at < self.last:
                seq, begin, stop = at // window, at - at % window, at - at % window + window
            else:
                k = bisect_right(self.cuts, at) - 1
                seq, begin = self.last // window + k, self.cuts[k]
                stop = self.cuts[k + 1]
            size = min(end, stop) - at
            yield row, start, size, self.plan.stream_seq + seq, at - begin
            start, at = start + size, at + size


# ----------------------------------------------------------------- operator

def store(pieces: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``token_pieces`` written down: the full windows, each with its number
    ``sequence_id`` (even), and the tails, each with its number ``row``."""
    path = scratch_path(pieces.sparkSession, "pieces")
    numbered = (pieces.withColumn("row", F.monotonically_increasing_id())
                .withColumn("whole", (F.col("length") == window).cast("int")))
    numbered.write.partitionBy("whole").parquet(path)
    written = pieces.sparkSession.read.schema(numbered.schema).parquet(path)
    return (written.filter("whole = 1").select((2 * F.col("row")).alias("sequence_id"), "id", "start", "length", "doc_tokens", "ids"),
            written.filter("whole = 0").drop("whole"))


def ranks(values: np.ndarray) -> np.ndarray:
    """Number of each value among its equals, in order."""
    order = np.argsort(values, kind="stable")
    held = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.searchsorted(held, held, "left")
    return out


def pack_tails(tails: DataFrame, width: str, window: int = WINDOW, max_slack: int = 0) -> DataFrame:
    """The packed windows of the tails: (sequence_id, ids binary, pieces), odd
    numbers."""
    n_cells = groups_for(tails.agg(F.sum("length")).first()[0], CELL_IDS)
    step = np.dtype(width).itemsize
    kind = tails.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        length = table.column("length").to_numpy().astype(np.int64)
        found, count = np.unique(length, return_counts=True)
        placer = Placer(plan_windows(dict(zip(found.tolist(), count.tolist())), window, max_slack))
        parts = np.array(list(placer.place(length, ranks(length))), np.int64).reshape(-1, 5)
        row, cut, size, seq, at = parts[np.lexsort((parts[:, 4], parts[:, 3]))].T
        first = np.flatnonzero(at == 0)                       # of every window
        ids = table.column("ids").combine_chunks()
        begin = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + len(ids)].astype(np.int64)[row] + cut * step
        data = memoryview(ids.buffers()[2]) if len(ids) else memoryview(b"")
        joined = b"".join([data[a:b] for a, b in zip(begin.tolist(), (begin + size * step).tolist())])
        until = np.concatenate([[0], np.cumsum(size)])[[*first, len(size)]] * step
        pieces = pa.StructArray.from_arrays(
            [table.column("id").combine_chunks().take(pa.array(row)), pa.array(table.column("start").to_numpy()[row] + cut),
             pa.array(size), pa.array(table.column("doc_tokens").to_numpy()[row]), pa.array(at)],
            ["id", "start", "length", "doc_tokens", "offset"])
        cell = table.column("cell")[0].as_py() if table.num_rows else 0
        return pa.table({
            "sequence_id": pa.array(2 * ((cell << 32) + seq[first]) + 1),
            "ids": pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(until.astype(np.int32)), pa.py_buffer(joined)]),
            "pieces": pa.ListArray.from_arrays(pa.array([*first, len(row)], pa.int32()), pieces)})

    cell = F.pmod(F.xxhash64("row"), F.lit(n_cells)).cast("int")
    return tails.withColumn("cell", cell).groupBy("cell").applyInArrow(
        run, f"sequence_id long, ids binary, pieces array<struct<id:{kind},start:long,length:long,doc_tokens:long,offset:long>>")


def read_pieces(windows: DataFrame, width: str, id_col: str = "doc_id") -> DataFrame:
    """One row per piece of written windows, with its ids (unsigned 32-bit,
    little-endian) and their checksum, cut out of the window."""
    kind = windows.schema["pieces"].dataType.elementType["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, READ_ROWS):
                batch = whole.slice(at, READ_ROWS)
                lists = batch.column("pieces")
                piece, of = lists.flatten(), np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
                window = [np.frombuffer(w.as_buffer(), width).astype("<u4").tobytes() for w in batch.column("ids")]
                begin = piece.field("offset").to_numpy() * 4
                until = begin + piece.field("length").to_numpy() * 4
                ids = [window[w][a:b] for w, a, b in zip(of.tolist(), begin.tolist(), until.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.field("id"), piece.field("start"), piece.field("length"), pa.array(map(zlib.crc32, ids), pa.int64()),
                     piece.field("doc_tokens"), batch.column("sequence_id").take(pa.array(of)), piece.field("offset"), pa.array(ids, pa.binary())],
                    [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return windows.mapInArrow(run, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                   "sequence_id long, offset long, ids binary")


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of the packed windows, which are written; its ids
    and their checksum are read from there."""
    with open(tokenizer_path, encoding="utf-8") as f:
        width = id_width(f.read(), end_id)
    full, tails = store(token_pieces(df, tokenizer_path, id_col, text_col, window, end_id), window)
    packed = materialize(pack_tails(tails, width, window), "windows")
    alone = F.array(F.struct("id", "start", F.col("length").cast("long").alias("length"), "doc_tokens",
                             F.lit(0).cast("long").alias("offset")))
    return read_pieces(full.select("sequence_id", "ids", alone.alias("pieces")).unionByName(packed), width, id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 ids."""
    return pack_documents(read_table(spark, sf_dir, "documents"), default_tokenizer()).drop("ids")
