"""Conversation repair against a plain search over edit sequences."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest

from forumlens.llm import repair

SMALL = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, pid int, copies int"


def damaged(rows):
    """(conv_id, turn, role, text) after damage, and every conv_id."""
    out: dict = {}
    for conv, turn, role, text in rows:
        here = out.setdefault(conv, [])
        role, text = role if role is not None else " ", text if text is not None else " "
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        if kind == 4:
            role = "user"
        here += [(turn, role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r))) for c, v in out.items()}


def plain(rows):
    """The contract's row of one conversation: least (cost, audit) over all edit sequences."""
    faults, seen = [], set()
    for _, role, text in rows:
        faults.append("blank" if not text.strip(BLANK) else "duplicate" if (role, text) in seen else
                      "truncated" if text.rstrip(BLANK)[-1] not in ".!?" else None)
        seen.add((role, text))
    # the pattern as an automaton over first letters
    lead = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @lru_cache(None)
    def best(i, state, inserted):
        """Least (cost, audit, output) from here; ``inserted``: rows just inserted, two at most are of use."""
        options = []
        if i == len(rows):
            if state in (0, 3):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            c, a, o = best(i + 1, state, 0)
            options.append((c + 2, "D" + a, o))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if role[:1] in lead[state]:
                    c, a, o = best(i + 1, lead[state][role[:1]], 0)
                    options.append((c + more, "K" + a, ((role, text), *o)))
                for new in ("user", "assistant"):
                    if new[0] in lead[state]:
                        c, a, o = best(i + 1, lead[state][new[0]], 0)
                        options.append((c + 1 + more, "R" + a, ((new, text), *o)))
        if inserted < 2:
            for new in ("user", "assistant"):
                if new[0] in lead[state]:
                    c, a, o = best(i, lead[state][new[0]], inserted + 1)
                    options.append((c + 5, "I" + a, ((new, ""), *o)))
        return min(options) if options else (10 ** 9, "", ())

    for i in range(len(rows), -1, -50):     # fill the cache from the end: no deep recursion
        for state in range(4):
            best(i, state, 0)
    cost, audit, output = best(0, 0, 0)
    turns = [t for t, _, _ in rows if t is not None]
    return ((max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in output).encode()).hexdigest())


def conversations(seed=0, n=120):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "and then", "What?", "", " \t", "ok.  \n", "a.b", "x", "\x1c", "...", None, "Well, \x0b", "é。"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher", "User"]
    rows = []
    for c in range(n):
        turn = 0
        for _ in range(r.choice([0, 1, 2, 3, 4, 6, 9, 14])):
            turn += r.choice([1, 1, 1, 1, 2, 0])
            rows.append((c, r.choice([turn] * 9 + [None]), r.choice(roles), r.choice(texts) if r.random() < 0.5 else f"text {r.random()}."))
    rows += [(None, 1, "user", "without id."), (None, None, None, None)] + rows[:3]
    for i in range(700):                                  # one long conversation
        rows.append((500, i // 2, r.choice(["user", "assistant", "system"]), r.choice(["Same.", f"t{r.randrange(400)}.", f"u{i}"])))
    rows += [(501, 3, "user", "copy.")] * 300
    return rows


def check(got, rows):
    want = {c: plain(tuple(v)) for c, v in damaged(rows).items()}
    have = {x[0]: tuple(x[1:]) for x in got}
    assert len(got) == len(want) and have.keys() == want.keys()
    for c in want:
        assert have[c] == want[c], (c, have[c], want[c])


@pytest.mark.parametrize("piece_rows", [4096, 3])
def test_repair_against_plain(spark, monkeypatch, tmp_dir, piece_rows):
    """Also with pieces of three rows, so that many conversations go the long way."""
    rows = conversations()
    table = spark.createDataFrame([(*x, "c", 1, 7) for x in rows], SCHEMA).repartition(6)
    table.write.parquet(f"{tmp_dir}/conversations.parquet")
    monkeypatch.setattr(repair, "PIECE_ROWS", piece_rows)
    repaired = repair.repair(repair.damage(table))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    if piece_rows == 4096:
        got = repair.op11_path_ranking(spark, tmp_dir)
        assert got.columns == ["conv_id", *names]
        check(got.collect(), rows)
    else:
        got = repair.digests(repaired)
        check([(None if x["conv"] == " " else int(x["conv"]), *(x[n] for n in names)) for x in got.collect()], rows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.digests(repair.repair(repair.damage(empty))).count() == 0


def batch(roles):
    """One piece with these roles, all texts distinct and whole."""
    n = len(roles)
    first = {"s": 0, "u": 1, "a": 2}
    columns = {"turns": list(range(n)), "initials": [first.get(r[:1], 3) for r in roles], "blank": [False] * n, "cut": [False] * n,
               "digests": [hashlib.md5(str(i).encode()).digest() for i in range(n)], "copies": [1] * n}
    types = {"turns": pa.int64(), "initials": pa.int32(), "blank": pa.bool_(), "cut": pa.bool_(), "digests": pa.binary(), "copies": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([columns[c]], pa.list_(types[c])) for c in columns], names=list(columns))


def test_ranks_order_all_least_audits():
    """The final ranks of the arcs order the least audits that start with them, as text."""
    r = random.Random(4)
    rows = repair.Rows(batch([r.choice(["user", "assistant", "system", "x"]) for _ in range(60)]))
    paths = repair.Paths(rows, np.array([repair.AT_END]))
    end = len(paths.frm)
    audits = []
    for arc in range(end):
        letters, at = [], arc
        while at != end:
            letters.append("DIKR"[paths.label[at]])
            at = int(paths.pointers[0][at])
        audits.append("".join(letters))
    distinct = sorted(set(audits))
    order = np.unique(paths.rank[:end], return_inverse=True)[1]
    assert [distinct.index(a) for a in audits] == order.tolist()
    for node in set(paths.frm.tolist()):
        arcs = [i for i in range(end) if paths.frm[i] == node]
        assert min(arcs, key=lambda i: audits[i]) == paths.first[node]


def test_registered_query(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    check(repair.op11_path_ranking(spark, SMALL).collect(), [tuple(x) for x in table.collect()])
