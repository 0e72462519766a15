"""Repair of conversation structure by cheapest edits, ranked by prefix doubling.

A conversation is legal if the first letters of its roles read ``(s?(ua)+)?``. Edits: keep a
row (cost 0), give it the role user or assistant (1), delete it (2; the only edit of blank and
duplicate rows), insert an empty user or assistant row anywhere (5); a truncated row that
stays adds 5. Nodes are (rows consumed, state of the pattern). A backward dynamic program
gives each node the least cost to the end; the arcs that attain it are the optimal ones. These
arcs are ranked by the letters of the audits that start with them, first by one letter,
then by two, four, eight ...: the rank over 2m letters is the rank of the pair (rank over m letters, rank
over m letters of the arc m steps on), and the pointers to that arc double along.
The arc of least rank at the start and the doubled pointers give the ASCII-least audit.

Long conversations are cut. Rows are range-partitioned by (conversation, turn, ...), so
one conversation may spread over many partitions, and cut into pieces of at most
PIECE_ROWS rows. Almost all conversations are one piece and are done where
they lie. Of the others, pieces exchange only small things: the digests of their rows (for
duplicates), a 4 x 4 matrix of least costs between the states at their ends, and the
states in which the least path enters them; these are folded in one pass in the order
of the pieces, holding one at a time. Only the final hash must read a
conversation in one stream, as SHA-256 cannot be put together from parts; it holds one piece at a time.

Defined results. Null roles and texts count as one space. A conversation whose id is null is
one of its own. Rows go by turn, nulls first; rows of equal turn by role, then by the digest of
role and text, so equal rows are neighbours. A role that is empty or starts with any
letter but s, u, a cannot be kept. Extra columns are not carried. A row with ``copies`` 0 counts as
no row, but its conversation is returned.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .store import written

PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5     # costs of the edits
S, U, A, OTHER = range(4)                                   # first letters of roles
# States of the pattern: nothing yet, after s, after u, after a. A user or assistant row leads on:
NEXT = np.array([2, 2, 3, 2])
ASKED = np.array([U, U, A, U])                              # the letter that does so
AT_END = np.array([0, 2 * INSERT, INSERT, 0])               # what completes the pattern
FAR = 1 << 60
LETTERS = np.frombuffer(b"DIKR", np.uint8)                  # in ASCII order
ROLES = {2: "user", 3: "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: rows dropped (0 copies), emptied, cut short, repeated, given
    another role, by crc32 of ``conv_id:turn`` modulo 20 (null: one space)."""
    def text_of(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


# ------------------------------------------------------------------ pieces
PIECE = ("pid int, seq long, open boolean, conv string, turns array<long>, initials array<int>, blank array<boolean>, "
         "cut array<boolean>, digests array<binary>, copies array<int>, roles array<string>, texts array<string>")
ROW_COLUMNS = ("turns", "initials", "blank", "cut", "digests", "copies", "roles", "texts")


def pieces(rows: DataFrame) -> DataFrame:
    """The rows of each conversation in order, as records of at most PIECE_ROWS rows.

    ``open`` pieces may belong to a longer conversation: those at the ends of a partition
    and those that were cut.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    initial = F.substring("roles", 1, 1)
    last = F.substring(F.rtrim(F.col("texts"), F.lit(BLANKS)), -1, 1)
    digest = F.unhex(F.md5(F.concat(F.length("roles").cast("string"), F.lit(":"), "roles", "texts")))
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    table = (rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"),
                         F.col("turn").cast("long").alias("turns"), copies.cast("int").alias("copies"),
                         role.alias("roles"), text.alias("texts"))
             .withColumn("initials", F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER))
             .withColumn("blank", last == "").withColumn("cut", ~last.isin(".", "!", "?"))
             .withColumn("digests", digest)
             # equal rows may go to several partitions: their order does not matter
             .withColumn("salt", F.monotonically_increasing_id()))
    order = [F.col("conv"), F.col("turns").asc_nulls_first(), F.col("roles"), F.col("digests"), F.col("salt")]
    ordered = table.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", *ROW_COLUMNS)

    def cut(batches):
        pid, seq = TaskContext.get().partitionId(), 0
        held, continued = None, True        # the held rows may go on from before: their pieces are open
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            if not len(table):
                continue
            code = np.asarray(_whole(table, "conv").dictionary_encode().indices)
            size = np.asarray(pc.binary_length(_whole(table, "texts"))).astype(np.int64) + 64
            into = np.r_[0, np.cumsum(size)]
            run = np.r_[0, np.flatnonzero(code[1:] != code[:-1]) + 1, len(code)]
            bounds, open_, going_on = [0], [], False
            for i, (a, b) in enumerate(zip(run, run[1:])):
                going_on, at = continued and i == 0, a
                while True:
                    full = int(np.searchsorted(into, into[at] + PIECE_BYTES, "right")) - 1
                    to = max(min(at + PIECE_ROWS, full), at + 1)
                    if to >= b:
                        break
                    bounds.append(to)
                    open_.append(True)
                    going_on, at = True, to
                if b < len(code):           # the last run may go on in the next batch
                    bounds.append(b)
                    open_.append(going_on)
            continued = going_on
            held = table.slice(bounds[-1])
            if open_:
                yield _records(table, bounds, open_, pid, seq)
                seq += len(open_)
        if held is not None:
            yield _records(held, [0, len(held)], [True], pid, seq)

    return written(ordered.mapInArrow(cut, PIECE), "conversation-pieces")


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _records(table: pa.Table, bounds: list, open_: list, pid: int, seq: int) -> pa.RecordBatch:
    n, at = len(open_), pa.array(bounds, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([pid] * n, pa.int32()), pa.array(range(seq, seq + n), pa.int64()), pa.array(open_),
         _whole(table, "conv").take(pa.array(bounds[:-1])), *(pa.ListArray.from_arrays(at, _whole(table, c)) for c in ROW_COLUMNS)],
        names=["pid", "seq", "open", "conv", *ROW_COLUMNS])


class Rows:
    """The rows of a batch of pieces after their copies are written out, as flat arrays."""

    def __init__(self, batch: pa.RecordBatch, seen: list | None = None):
        def flat(name):
            return batch.column(name).flatten()

        copies = np.asarray(flat("copies"))
        count = np.asarray(batch.column("copies").value_lengths()).astype(np.int64)
        of = np.repeat(np.arange(len(batch)), count)
        self.source = np.repeat(np.arange(len(copies)), copies)          # row of the batch that each stands for
        self.piece = of[self.source]
        self.bounds = np.searchsorted(self.piece, np.arange(len(batch) + 1))
        self.initial = np.asarray(flat("initials"))[self.source]
        self.blank = np.asarray(flat("blank").to_numpy(zero_copy_only=False), bool)[self.source]
        self.turns = flat("turns")
        cut = np.asarray(flat("cut").to_numpy(zero_copy_only=False), bool)[self.source]
        digests = flat("digests")
        raw = np.frombuffer(b"".join(digests.to_pylist()), ">i8").reshape(-1, 2)[self.source]
        order = np.lexsort((raw[:, 1], raw[:, 0], self.piece))           # stable: rows in order
        same = np.zeros(len(order), bool)
        same[1:] = (self.piece[order][1:] == self.piece[order][:-1]) & (raw[order][1:] == raw[order][:-1]).all(1)
        repeated = np.zeros(len(order), bool)
        repeated[order] = same
        self.first = ~repeated                                           # of its piece
        if seen is not None:                                             # digests that earlier pieces hold
            earlier = [frozenset(s) if s is not None else frozenset() for s in seen]
            if any(earlier):
                values = digests.to_pylist()
                repeated |= np.array([values[s] in earlier[p] for s, p in zip(self.source, self.piece)], bool)
        self.duplicate = ~self.blank & repeated
        self.truncated = ~self.blank & ~self.duplicate & cut
        self.gone = self.blank | self.duplicate

    def turns_of(self) -> list[tuple]:
        """(least turn, greatest turn, distinct turns) of each piece, nulls left out."""
        turns = np.array(self.turns.fill_null(0))[self.source]
        known = np.array(self.turns.is_valid())[self.source]
        out = []
        for a, b in zip(self.bounds, self.bounds[1:]):
            t = turns[a:b][known[a:b]]
            out.append((int(t[0]), int(t[-1]), int(1 + (t[1:] != t[:-1]).sum())) if len(t) else (None, None, 0))
        return out


# ------------------------------------------------------------------ cost DP and ranks
def _relaxed(e: np.ndarray) -> np.ndarray:
    """Least costs (.., state) when rows may also be inserted."""
    out = e.copy()
    out[..., 2] = np.minimum(e[..., 2], INSERT + e[..., 3])
    out[..., 3] = np.minimum(e[..., 3], INSERT + e[..., 2])
    out[..., 0] = np.minimum(e[..., 0], INSERT + out[..., 2])
    out[..., 1] = np.minimum(e[..., 1], INSERT + out[..., 2])
    return np.minimum(out, FAR)


def _row_arcs(rows: Rows, at: np.ndarray, after: np.ndarray):
    """Cost of each edit of the rows ``at`` from each state, ``after`` the costs behind them:
    arrays (rows, ..., state) in the order of DIKR, without the insertions."""
    shape = (len(at),) + (1,) * (after.ndim - 1)
    gone, extra = rows.gone[at].reshape(shape), (TRUNCATED * rows.truncated[at]).reshape(shape)
    initial = rows.initial[at].reshape(shape)
    on = after[..., NEXT]
    keep = np.where(~gone & (initial == ASKED), KEEP + extra + on, FAR)
    keep[..., 0] = np.where(~gone[..., 0] & (initial[..., 0] == S), KEEP + extra[..., 0] + after[..., 1], keep[..., 0])
    rerole = np.where(gone, FAR, REROLE + extra + on)
    return DELETE + after, keep, rerole


def costs(rows: Rows, ends: np.ndarray) -> np.ndarray:
    """Least cost from every node to the end of its piece: (rows + pieces, ..., state).

    ``ends[p]`` is the cost behind the last row of piece p; node (row i of piece p) is at
    ``bounds[p] + p + i``. All pieces advance together, one row a step.
    """
    n = len(rows.bounds) - 1
    size = np.diff(rows.bounds)
    base = rows.bounds[:-1] + np.arange(n)
    out = np.empty((len(rows.piece) + n,) + ends.shape[1:], np.int64)
    out[base + size] = ends
    order = np.argsort(-size, kind="stable")
    live_size = size[order]
    for t in range(int(size.max(initial=0)) - 1, -1, -1):
        live = order[:np.searchsorted(-live_size, -t, "left")]           # pieces of more than t rows
        delete, keep, rerole = _row_arcs(rows, rows.bounds[live] + t, out[base[live] + t + 1])
        out[base[live] + t] = _relaxed(np.minimum(np.minimum(delete, keep), rerole))
    return out


class Paths:
    """Optimal arcs of all nodes, ranked by prefix doubling."""

    def __init__(self, rows: Rows, ends: np.ndarray):
        n = len(rows.bounds) - 1
        self.base = rows.bounds[:-1] + np.arange(n)
        self.size = np.diff(rows.bounds)
        self.cost = cost = costs(rows, ends)
        node = np.arange(len(rows.piece)) + rows.piece                   # the node before each row
        here, after = cost[node], cost[node + 1]
        delete, keep, rerole = _row_arcs(rows, np.arange(len(node)), after)
        kept_at = np.broadcast_to(NEXT, here.shape).copy()
        kept_at[:, 0] = np.where(rows.initial == S, 1, NEXT[0])
        options = [(0, delete, np.broadcast_to(np.arange(4), here.shape), 1), (1, INSERT + here[:, NEXT], np.broadcast_to(NEXT, here.shape), 0),
                   (2, keep, kept_at, 1), (3, rerole, np.broadcast_to(NEXT, here.shape), 1)]
        frm, to, label = [], [], []
        for letter, c, state, step in options:
            r, s = np.nonzero((c == here) & (here < FAR))
            frm.append(node[r] * 4 + s)
            to.append((node[r] + step) * 4 + state[r, s])
            label.append(np.full(len(r), letter))
        frm, to, label = (np.concatenate(x) for x in (frm, to, label))
        order = np.lexsort((label, frm))
        self.frm, self.to, self.label = frm[order], to[order], label[order]
        # rank by one letter, then by two, four ...; the last arc stands for the end
        end = len(self.frm)
        rank = np.append(self.label + 1, 0)
        self.first = np.full(cost.shape[0] * 4, end)                     # arc of least rank at each node
        least = np.r_[True, self.frm[1:] != self.frm[:-1]] if end else np.zeros(0, bool)
        self.first[self.frm[least]] = np.flatnonzero(least)
        pointer = np.append(self.first[self.to], end)
        self.pointers = [pointer]
        while (pointer != end).any():
            pair = rank * (int(rank.max()) + 1) + rank[pointer]
            _, rank = np.unique(pair, return_inverse=True)
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        # labels that leave a node differ, so ranks of more letters keep the choice of the first
        self.rank = rank

    def walk(self, states: np.ndarray):
        """For each piece and its entry state: the arcs of the least path, and the state it ends in (-1: none)."""
        end = len(self.frm)
        start = self.first[self.base * 4 + states]
        steps = np.zeros(len(start), np.int64)                           # arcs on each path, from the doubled pointers
        at = start.copy()
        for k in range(len(self.pointers) - 1, -1, -1):
            further = self.pointers[k][at]
            go = (at != end) & (further != end)
            steps[go] += 1 << k
            at = np.where(go, further, at)
        steps += start != end
        exit_ = np.where(start == end, np.where((self.size == 0), states, -1), self.to[np.minimum(at, end - 1)] % 4 if end else states)
        paths: list = [None] * len(start)
        level = np.ceil(np.log2(np.maximum(steps, 1))).astype(int)
        for k in np.unique(level):
            which = np.flatnonzero(level == k)
            arcs = start[which][:, None]
            for j in range(k - 1, -1, -1):
                arcs = np.stack([arcs, self.pointers[j][arcs]], -1).reshape(len(which), -1)
            for p, line in zip(which, arcs):
                paths[p] = line[:steps[p]]
        return paths, exit_


# ------------------------------------------------------------------ repair
REPAIRED = ("conv string, pid int, seq long, open boolean, audit string, roles array<string>, texts array<string>, cost long, "
            "n long, blank long, duplicate long, truncated long, illegal long, first_initial int, last_initial int, "
            "least_turn long, greatest_turn long, distinct_turns long")


def _legal(a: int, b: int) -> bool:
    return (a, b) in ((S, U), (U, A), (A, U))


def _edit(batch: pa.RecordBatch, entries: np.ndarray, ends: np.ndarray, last: list, seen: list | None) -> dict:
    """Columns of REPAIRED for a batch of pieces that the least path enters in ``entries``."""
    rows = Rows(batch, seen)
    paths = Paths(rows, ends)
    walks, exits = paths.walk(entries)
    roles, texts = (batch.column(c).flatten().to_pylist() for c in ("roles", "texts"))
    out: dict = {name: [] for name in ("audit", "roles", "texts", "cost", "n", "blank", "duplicate", "truncated", "illegal",
                                       "first_initial", "last_initial", "least_turn", "greatest_turn", "distinct_turns")}
    turns = rows.turns_of()
    for p, arcs in enumerate(walks):
        a, b = int(rows.bounds[p]), int(rows.bounds[p + 1])
        letters = LETTERS[paths.label[arcs]].tobytes().decode()
        states = (paths.to[arcs] % 4).tolist()
        new_roles, new_texts, at, cost = [], [], a, 0
        for letter, state in zip(letters, states):
            if letter == "I":
                new_roles.append(ROLES[state])
                new_texts.append("")
                cost += INSERT
                continue
            if letter == "D":
                cost += DELETE
            else:
                source = rows.source[at]
                new_roles.append(roles[source] if letter == "K" else ROLES[state])
                new_texts.append(texts[source])
                cost += (REROLE if letter == "R" else KEEP) + TRUNCATED * int(rows.truncated[at])
            at += 1
        if last[p]:
            state = int(exits[p])
            while AT_END[state]:
                state = int(NEXT[state])
                new_roles.append(ROLES[state])
                new_texts.append("")
                letters += "I"
                cost += INSERT
        initial = rows.initial[a:b].tolist()
        values = (letters, new_roles, new_texts, cost, b - a, int(rows.blank[a:b].sum()), int(rows.duplicate[a:b].sum()),
                  int(rows.truncated[a:b].sum()), sum(not _legal(x, y) for x, y in zip(initial, initial[1:])),
                  initial[0] if initial else None, initial[-1] if initial else None, *turns[p])
        for name, value in zip(out, values):
            out[name].append(value)
    return out


def _arrow(schema: str) -> pa.Schema:
    """The Arrow form of a schema in text; parsed on the driver."""
    return to_arrow_schema(StructType.fromDDL(schema))


def _repaired(edit, pieces_: DataFrame) -> DataFrame:
    arrow = _arrow(REPAIRED)

    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 2048):
                part = batch.slice(a, 2048)
                columns = edit(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(f.name) if f.name in ("conv", "pid", "seq", "open") else pa.array(columns[f.name], f.type)
                     for f in arrow], schema=arrow)

    return pieces_.mapInArrow(run, REPAIRED)


def _stream(df: DataFrame, backward: bool, fold, schema: str) -> DataFrame:
    """``fold(rows)`` over the pieces of each conversation in order (or from the last one), one at a time.

    A task holds one row; ``fold`` is a generator function over the rows of one conversation.
    """
    arrow = _arrow(schema)
    by = ([F.col("pid").desc(), F.col("seq").desc()] if backward else [F.col("pid"), F.col("seq")])

    def run(batches):
        def each():
            for batch in batches:
                for i in range(len(batch)):
                    yield batch.slice(i, 1).to_pylist()[0]

        for _, group in groupby(each(), key=lambda r: r["conv"]):
            for row in fold(group):
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    return df.repartition("conv").sortWithinPartitions("conv", *by).mapInArrow(run, schema)


def _fold_ends(group):
    behind = AT_END
    for i, r in enumerate(group):
        yield {"pid": r["pid"], "seq": r["seq"], "ends": behind.tolist(), "last": i == 0}
        behind = (np.array(r["matrix"]).reshape(4, 4) + behind).min(1)


def _fold_entries(group):
    state = 0
    for r in group:
        yield {"pid": r["pid"], "seq": r["seq"], "entry": state, "ends": r["ends"], "last": r["last"]}
        state = r["exits"][state]


def repair(rows: DataFrame) -> DataFrame:
    """Repaired pieces (REPAIRED): the pieces of a conversation in the order of (pid, seq) are its new rows.

    ``rows`` has conv_id, turn, role, text and may have ``copies``, how often a row stands.
    """
    table = pieces(rows)
    narrow = [c for c in table.columns if c not in ("roles", "texts")]
    ends = AT_END

    def whole(batch):
        n = len(batch)
        return _edit(batch, np.zeros(n, int), np.tile(ends, (n, 1)), [True] * n, None)

    done = _repaired(whole, table.where("not open"))
    return done.unionByName(_long(table.where("open"), narrow))


def _long(table: DataFrame, narrow: list[str]) -> DataFrame:
    """The open pieces, in the order of their conversations."""
    def digests(batches):
        for batch in batches:
            rows = Rows(batch)
            keep = rows.first & ~rows.blank
            piece, values = rows.piece[keep], batch.column("digests").flatten().take(pa.array(rows.source[keep]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(piece)) for c in ("conv", "pid", "seq")), values],
                                             names=["conv", "pid", "seq", "digest"])

    held = written(table.select(*narrow).mapInArrow(digests, "conv string, pid int, seq long, digest binary"), "conversation-digests")
    at = F.struct("pid", "seq")
    first = held.groupBy("conv", "digest").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # at most PIECE_ROWS digests a piece
    seen = held.join(first, ["conv", "digest"]).where(at > F.col("first")).groupBy("pid", "seq").agg(
        F.collect_list("digest").alias("seen"))
    known = written(table.select(*narrow).join(seen, ["pid", "seq"], "left"), "conversation-seen")

    def matrices(batches):
        for batch in batches:
            rows = Rows(batch, batch.column("seen").to_pylist())
            unit = np.where(np.eye(4, dtype=bool), 0, FAR)
            table = costs(rows, np.tile(unit, (len(batch), 1, 1)))       # (node, end state, state)
            at = rows.bounds[:-1] + np.arange(len(batch))
            flat = table[at].transpose(0, 2, 1).reshape(len(batch), 16)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "pid", "seq")), pa.array(flat.tolist(), pa.list_(pa.int64()))],
                                             names=["conv", "pid", "seq", "matrix"])

    folded = written(_stream(known.mapInArrow(matrices, "conv string, pid int, seq long, matrix array<long>"), True, _fold_ends,
                             "pid int, seq long, ends array<long>, last boolean"), "conversation-ends")

    def exits(batches):
        for batch in batches:
            rows = Rows(batch, batch.column("seen").to_pylist())
            ends = np.array(batch.column("ends").to_pylist(), np.int64).reshape(len(batch), 4)
            paths = Paths(rows, ends)
            out = np.stack([paths.walk(np.full(len(batch), s))[1] for s in range(4)], 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv", "pid", "seq", "ends", "last")), pa.array(out.tolist(), pa.list_(pa.int32()))],
                names=["conv", "pid", "seq", "ends", "last", "exits"])

    both = known.join(folded, ["pid", "seq"]).mapInArrow(
        exits, "conv string, pid int, seq long, ends array<long>, last boolean, exits array<int>")
    control = written(_stream(both, False, _fold_entries, "pid int, seq long, entry int, ends array<long>, last boolean").join(
        known.select("pid", "seq", "seen"), ["pid", "seq"]), "conversation-control")

    def edit(batch):
        return _edit(batch, np.asarray(batch.column("entry")), np.array(batch.column("ends").to_pylist(), np.int64).reshape(-1, 4),
                     batch.column("last").to_pylist(), batch.column("seen").to_pylist())

    return _repaired(edit, table.join(control, ["pid", "seq"]))


# ------------------------------------------------------------------ digests
DIGESTS = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _fold_digest(group):
    text, started, audit = hashlib.sha256(), False, []
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
    least = greatest = before = None
    distinct = 0
    for r in group:
        for role, line in zip(r["roles"], r["texts"]):
            text.update((("\n" if started else "") + f"{role}:{line}").encode())
            started = True
        audit.append(r["audit"])
        for name in total:
            total[name] += r[name]
        if r["n"]:
            total["illegal"] += before is not None and not _legal(before, r["first_initial"])
            before = r["last_initial"]
        if r["least_turn"] is not None:
            distinct += r["distinct_turns"] - (greatest == r["least_turn"])
            least, greatest = r["least_turn"] if least is None else least, r["greatest_turn"]
    yield {"conv": r["conv"], "gaps": 0 if least is None else greatest - least + 1 - distinct, **total,
           "audit": "".join(audit), "repaired_sha256": text.hexdigest()}


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the hash of the repaired rows."""
    arrow = _arrow(DIGESTS)

    def single(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([row for r in batch.to_pylist() for row in _fold_digest([r])], schema=arrow)

    return repaired.where("not open").mapInArrow(single, DIGESTS).unionByName(
        _stream(repaired.where("open"), False, _fold_digest, DIGESTS))


def op11_path_ranking(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    kind = table.schema["conv_id"].dataType
    found = digests(repair(damage(table)))
    return found.select(F.when(F.col("conv") != " ", F.col("conv")).cast(kind).alias("conv_id"), *found.columns[1:])
