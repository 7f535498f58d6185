"""Byte-level BPE: encoding and decoding with DuckDB recursive queries inside each task.

A rank file gives every token its bytes and rank.  The merge table lists the pair of tokens whose merge
makes a token: (left, right) -> merged, whose rank is its id.  A task collects the distinct
pre-tokens ("words") of a stretch of texts and encodes them in one recursive query: a
row per word, position and token; every round joins each word's leftmost minimum-rank pair with
the merge table, contracts it, and looks up the ranks of the two new neighbours; a word leaves the
recursion when no pair of it is in the table.  Decoding joins token rows with the vocabulary and
concatenates the bytes by an ordered aggregate.  Words are independent, so a text's ids (and
decoded bytes) are those of its words in order; each distinct word is worked on once per stretch.

A long word is encoded in overlapping windows, all in one query, and put together where neighbouring windows hold the same token: a
list of tokens is the encoding of its bytes if every two neighbours are the encoding of theirs, which holds inside each
window and across a shared token.  Neighbours that share none become one window.  This needs every token to be made of two of lower
rank, which is checked for the rank file; a word is else contracted as a whole.  Windows that have grown
contract all non-overlapping pairs of their lowest rank in a round, so that a run of equal letters takes few.

Memory of a worker is bounded in bytes: what it remembers (``MEMO_BYTES``), the rows of a recursive query (``CHUNK_BYTES`` x rounds),
and DuckDB's own ``DUCK_MEMORY``.

Defined cases: a null or empty text has no tokens; special tokens are ordinary text; a text of any
length is encoded whole.  Null ids or extra columns do not matter; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import store

ROUNDS = 12                  # of contraction in one recursive query; words that need more take several
STRETCH_BYTES = 2 << 20      # of text whose distinct words are encoded together
CHUNK_BYTES = 1 << 16        # of words in one recursive query
ROUND_ROWS = 1 << 20         # rows of all rounds of one query over a word longer than a chunk
MEMO_BYTES = 96 << 20        # pieces of text whose ids a Python worker remembers, and as many older ones
ENTRY_BYTES = 200            # of a remembered piece besides its characters and ids
DUCK_MEMORY = "400MB"
LONG = 64                    # bytes; a longer word is encoded in windows
WINDOW = 32                  # bytes of a window at first; windows overlap by half
WIDE = 64                    # bytes; a wider window contracts all pairs of its lowest rank in a round

ENCODED = "row long, n_tokens long, ids binary, decoded binary"

# A row is one token of an unfinished word: id of its first byte, the next token and where that
# starts, and the rank of the pair of both.  ``spot`` is the pair to contract.
_CONTRACT = """
with recursive step(word, pos, token, next_pos, next, pair_rank, round) as (
  select word, pos, token, next_pos, next, m.merged, 0
  from start left join merges m on token * 65536 + next = m.pair
  union all
  select * from (
    with best as (
      select word, min((pair_rank::bigint << 40) | pos) as k from step where round < {rounds}
      group by word having k is not null),
    found as (select c.word, c.pos, c.next_pos, c.pair_rank from step c join best on c.pos = best.k & 1099511627775),
    spot as (
      select c.word, c.pos as spot, c.next_pos as gone, c.pair_rank::bigint as token,
             n.next_pos as after_pos, n.next as after
      from step n join found c on n.pos = c.next_pos),
    made as (
      select spot.*, m.merged as right_rank
      from spot left join merges m on spot.token * 65536 + spot.after = m.pair)
    select c.word, c.pos,
      case when c.pos = spot then made.token else c.token end,
      case when c.pos = spot then after_pos else c.next_pos end,
      case when c.pos = spot then after when c.next_pos = spot then made.token else c.next end,
      case when c.pos = spot then right_rank when c.next_pos = spot then m.merged else c.pair_rank end,
      c.round + 1
    from step c join made on c.word = made.word
    left join merges m on (case when c.next_pos = spot then c.token * 65536 + made.token end) = m.pair
    where c.pos <> gone))
select step.word, pos, token, next_pos, next, step.round = {rounds} as open
from step join (select word, max(round) as round from step group by word) last
  on step.word = last.word and step.round = last.round
"""

# The same for long windows: every pair of a word's lowest rank contracts, in a run of them every other one.
_CONTRACT_ALL = """
with recursive step(word, pos, token, pair_rank, round) as (
  select word, pos, token, m.merged, 0 from start left join merges m on token * 65536 + next = m.pair
  union all
  select * from (
    with marked as (
      select *, min(pair_rank) over (partition by word) as lowest, row_number() over (partition by word order by pos) as place
      from step where round < {rounds}),
    runs as (
      select *, place - max(case when pair_rank is distinct from lowest then place else 0 end)
                        over (partition by word order by pos) as nth from marked where lowest is not null),
    spots as (
      select *, nth % 2 = 1 as spot, lag(nth % 2 = 1, 1, false) over (partition by word order by pos) as gone from runs),
    kept as (
      select word, pos, case when spot then lowest else token end as token, round from spots where not gone),
    paired as (select *, lead(token) over (partition by word order by pos) as next from kept)
    select word, pos, token, m.merged, round + 1 from paired left join merges m on token * 65536 + next = m.pair))
select step.word, pos, token, lead(token) over (partition by step.word order by pos) as next, step.round = {rounds} as open
from step join (select word, max(round) as round from step group by word) last
  on step.word = last.word and step.round = last.round
"""

_DECODED = "select string_agg(v.hex, '' order by t.pos) from tokens t join vocabulary v on v.token = t.token"
_DECODED_WORDS = "select t.word, string_agg(v.hex, '' order by t.pos) from tokens t join vocabulary v on v.token = t.token group by t.word"


def _last_merge(token: bytes, ranks: dict[bytes, int]) -> int:
    """Where the last merge that makes ``token`` joins its two parts, of lower rank both; 0 if none does."""
    parts, own = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        found = [(ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True))]
        rank, i = min(found)
        if rank >= own:
            return 0
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return len(parts[0]) if all(ranks.get(p, own) < own for p in parts) else 0


class Ranks:
    """A rank file: token bytes by id, the merge table, and the id of each byte."""

    def __init__(self, lines: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids must be below 65536")
        # Whether every token comes of exactly one merge of two tokens of lower rank.  Then only these merges
        # ever happen, and all pairs of a word's lowest rank can contract at once.
        last = {token: _last_merge(token, ranks) for token in ranks if len(token) > 1}
        self.ascending = all(last.values())
        pairs, merged = [], []
        for token, cuts in last.items():
            for k in [cuts] if self.ascending else range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs.append((a << 16) + b)
                    merged.append(ranks[token])
        self.pairs, self.merged = np.array(pairs, np.int64), np.array(merged, np.int64)
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.id_of = ranks
        self._encoders: dict[str, Encoder] = {}

    def encoder(self, pattern: str) -> Encoder:
        """One per pattern; a worker keeps its copy of the broadcast ranks, so also between tasks."""
        if pattern not in self._encoders:
            self._encoders[pattern] = Encoder(self, pattern)
        return self._encoders[pattern]


class Encoder:
    """Encodes words in an in-memory DuckDB; remembers recent pieces of text."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": DUCK_MEMORY})
        # Every join is written with its small side on the right; rows of a recursion have no statistics to choose by.
        self.db.execute("set disabled_optimizers = 'join_order,build_side_probe_side'")
        self._table("merges", pair=ranks.pairs, merged=ranks.merged)
        ids = list(ranks.bytes_of)
        self._table("vocabulary", token=np.array(ids), hex=[ranks.bytes_of[i].hex() for i in ids])
        self.ragged = re.compile(r"\A\s|\s\Z| \s|\s ")
        self.ids: dict[str, bytes] = {}                 # of pieces of text, remembered
        self.older: dict[str, bytes] = {}
        self.size = 0                                   # of what is remembered, in bytes
        self.unlike: dict[bytes, bytes] = {}             # decoded bytes of pieces where they are not the piece's own

    def _table(self, name: str, **columns) -> None:
        self.db.register("arriving", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.db.execute(f"create or replace table {name} as select * from arriving")
        self.db.unregister("arriving")

    def _contract(self, words: list[bytes], long: bool = False) -> pa.Table:
        """(word, pos, token) of every word at the fixpoint; ``word`` is the list index."""
        buf = np.frombuffer(b"".join(words), np.uint8)
        lens = np.array([len(w) for w in words])
        pos, last = np.arange(len(buf)), np.cumsum(lens) - 1
        tokens, end = self.ranks.single[buf], np.zeros(len(buf), bool)
        end[last] = True
        rows = {"word": pa.array(np.repeat(np.arange(len(words)), lens)), "pos": pa.array(pos),
                "token": pa.array(tokens), "next": pa.array(np.append(tokens[1:], 0), mask=end)}
        if not long:
            rows["next_pos"] = pa.array(pos + 1, mask=end)
        rows, done = pa.table(rows), []
        while rows.num_rows:
            rounds = max(1, min(ROUNDS, ROUND_ROWS // rows.num_rows))
            self.db.register("start", rows)
            out = self.db.sql((_CONTRACT_ALL if long else _CONTRACT).format(rounds=rounds)).to_arrow_table()
            self.db.unregister("start")
            done.append(out.filter(pa.compute.invert(out["open"])).select(["word", "pos", "token"]))
            rows = out.filter(out["open"]).drop_columns(["open"])
        return pa.concat_tables(done)

    def _encode(self, words: list[bytes], wide: bool) -> Iterator[bytes]:
        """Ids of each word as little-endian 32-bit integers, chunk by chunk; decodes each chunk."""
        at, size = 0, 0
        for k in range(len(words) + 1):
            if k > at and (k == len(words) or size >= CHUNK_BYTES):
                done = self._contract(words[at:k], wide)
                word, pos, token = (np.asarray(done[c].combine_chunks()) for c in ("word", "pos", "token"))
                order = np.argsort(pos)
                ids = token[order].astype("<u4").tobytes()
                cuts = (4 * np.searchsorted(word[order], np.arange(k - at + 1))).tolist()
                self._decode(words[at:k], word, pos, token)
                yield from (ids[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True))
                at, size = k, 0
            if k < len(words):
                size += len(words[k])

    def _decode(self, words: list[bytes], word: np.ndarray, pos: np.ndarray, token: np.ndarray) -> None:
        """Decodes token rows by an ordered aggregate; notes the words that do not come back as they were."""
        self._table("tokens", word=word, pos=pos, token=token)
        if self.db.sql(_DECODED).fetchall()[0][0] != b"".join(words).hex():
            for w, decoded in self.db.sql(_DECODED_WORDS).fetchall():
                if decoded != words[w].hex():
                    self.unlike[words[w]] = bytes.fromhex(decoded)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """word -> ids as little-endian 32-bit integers; decodes them too."""
        out, short, raw_short, long = {}, [], [], []
        for w in words:
            raw = w.encode()
            token = self.ranks.id_of.get(raw)
            if token is not None:                       # a whole token is its own encoding
                out[w] = token.to_bytes(4, "little")
            elif len(raw) <= LONG or not self.ranks.ascending:
                short.append(w)
                raw_short.append(raw)
            else:
                long.append((w, raw))
        out.update(zip(short, self._encode(raw_short, False), strict=True))
        for w, raw in long:
            ids = self._long(raw)
            out[w] = ids.astype("<u4").tobytes()
            self._decode([raw], np.zeros(len(ids), np.int64), np.arange(len(ids)), ids.astype(np.int64))
        return out

    def _long(self, raw: bytes) -> np.ndarray:
        """Ids of one long word, from windows."""
        step = WINDOW // 2
        spans = [(a, min(len(raw), a + WINDOW)) for a in range(0, len(raw) - step, step)]
        known: dict[bytes, np.ndarray] = {}
        while True:
            new = list(dict.fromkeys(p for a, z in spans if (p := raw[a:z]) not in known))
            for some, wide in (([p for p in new if len(p) <= WIDE], False), ([p for p in new if len(p) > WIDE], True)):
                known |= zip(some, (np.frombuffer(i, "<u4") for i in self._encode(some, wide)), strict=True)
            joined, apart = _joined(spans, [known[raw[a:z]] for a, z in spans], self.ranks.bytes_of)
            if not apart:
                return joined
            merged, k = [], 0
            while k < len(spans):                       # neighbours without a shared token become one window
                two = k in apart
                merged.append((spans[k][0], spans[k + two][1]))
                k += 1 + two
            spans = merged

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids, decoded bytes) of each text."""
        # A text is cut before single spaces where each piece splits by itself as it does inside the
        # text: when no piece starts (after its space) or ends with white space.
        cut = [[t] if not t or self.ragged.search(t) else t.split(" ") for t in texts]
        for c in cut:
            c[1:] = [" " + p for p in c[1:]]
        new = self._missing(set().union(*cut))
        split = {c: self.pattern.findall(c) for c in new}
        words = self.encode_words(list(set().union(*split.values()))) if split else {}
        for c, ws in split.items():
            self._remember(c, words[ws[0]] if len(ws) == 1 else b"".join([words[w] for w in ws]))
            if self.unlike and any(w.encode() in self.unlike for w in ws):
                self.unlike[c.encode()] = b"".join([self.unlike.get(r := w.encode(), r) for w in ws])
        del words, split
        out = [(b"".join(map(self.ids.__getitem__, c)),
                b"".join([self.unlike.get(r := p.encode(), r) for p in c]) if self.unlike else t.encode())
               for c, t in zip(cut, texts, strict=True)]
        if self.size > MEMO_BYTES:                      # what was not met since the last time goes
            self.older, self.ids, self.size = self.ids, {}, 0
        return out

    def _remember(self, piece: str, ids: bytes) -> None:
        self.ids[piece] = ids
        self.size += ENTRY_BYTES + 2 * len(piece) + len(ids)

    def _missing(self, pieces: set[str]) -> set[str]:
        """The pieces not remembered; those remembered from before become recent."""
        new = pieces - self.ids.keys()
        for p in new & self.older.keys():
            self._remember(p, self.older[p])
        return new - self.older.keys()


def _joined(spans: list[tuple[int, int]], ids: list[np.ndarray], bytes_of: dict[int, bytes]) -> tuple[np.ndarray, set[int]]:
    """The tokens of a word from those of its overlapping windows, and the windows that share no token with the next."""
    out, apart, last = [], set(), None
    for k, ((start, _), tokens) in enumerate(zip(spans, ids, strict=True)):
        ends = start + np.cumsum([len(bytes_of[t]) for t in tokens.tolist()])
        begins, first = np.append(start, ends[:-1]), 0
        if last is not None:
            old, old_begins, old_ends, old_first = last
            _, here, there = np.intersect1d(begins << 32 | ends, old_begins << 32 | old_ends, assume_unique=True, return_indices=True)
            fits = here[there >= old_first]
            if fits.size:
                first = fits[0]
                out.append(old[old_first: there[there >= old_first][0]])
            else:
                apart.add(k - 1)
        last = (tokens, begins, ends, first)
    out.append(last[0][last[3]:])
    return np.concatenate(out), apart


def _task(ranks, pattern: str, finish):
    """Encodes batches of (key, text) in stretches; ``finish`` makes the output batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, held, size = None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            texts = [t or "" for b in held for t in b.column(b.num_columns - 1).to_pylist()]
            coded, at = encoder.encode(texts), 0
            for b in held:
                yield finish(b, coded[at: at + b.num_rows])
                at += b.num_rows

        for batch in batches:
            encoder = encoder or ranks.value.encoder(pattern)
            held.append(batch)
            size += batch.nbytes
            if size >= STRETCH_BYTES:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()
    return run


def _digests(batch: pa.RecordBatch, coded: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:-1], pa.array([len(i) // 4 for i, _ in coded], pa.int64()),
         pa.array([hashlib.sha256(i).hexdigest() for i, _ in coded], pa.string()),
         pa.array([hashlib.sha256(d).hexdigest() for _, d in coded], pa.string())],
        names=[*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"])


def _whole(batch: pa.RecordBatch, coded: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    ids = [np.frombuffer(i, "<u4").astype(np.int32) for i, _ in coded]
    return pa.RecordBatch.from_arrays(
        [*batch.columns[:-1], pa.array(ids, pa.list_(pa.int32())),
         pa.array([d.decode(errors="replace") for _, d in coded], pa.string())],
        names=[*batch.schema.names[:-1], "ids", "decoded"])


def load(path: str) -> Ranks:
    """Ranks of a ``.tiktoken`` file (base64 token and id per line), read on the driver."""
    with open(path, "rb") as f:
        return Ranks(f.read())


def _run(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, finish, columns: str) -> DataFrame:
    spark = docs.sparkSession
    store.small_batches(spark)
    ranks = spark.sparkContext.broadcast(load(path))     # bounded by the 16-bit ids
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(_task(ranks, pattern, finish), "doc_id long, " + columns)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) per row: token ids of the whole text, and the text decoded from them."""
    return _run(docs, path, pattern, id_col, text_col, _whole, "ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``."""
    return _run(docs, path, pattern, id_col, text_col, _digests,
                "n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) from arrays of ids; an id outside the vocabulary is an error, null or [] is empty."""
    ranks = rows.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db = duckdb.connect(":memory:", config={"threads": 1})
        known = list(ranks.value.bytes_of.items())
        db.register("arriving", pa.table({"token": [i for i, _ in known], "hex": [t.hex() for _, t in known]}))
        db.execute("create table vocabulary as select * from arriving")
        for batch in batches:
            ids = batch.column(1).to_pylist()
            lens = np.array([len(i or ()) for i in ids], np.int64)
            flat = np.array([t for i in ids for t in i or ()], np.int64)
            if not np.isin(flat, [i for i, _ in known]).all():
                raise ValueError("an id is not in the vocabulary")
            db.register("tokens", pa.table({"word": np.repeat(np.arange(len(ids)), lens),
                                            "pos": np.arange(len(flat)), "token": flat}))
            text = dict(db.sql(_DECODED_WORDS).fetchall())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bytes.fromhex(text.get(k, "")) for k in range(len(ids))], pa.binary())],
                names=["doc_id", "decoded"])
    return (rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "doc_id long, decoded binary"))
