"""Plain versions of the operators for small inputs, and inputs with planted cases."""

from __future__ import annotations

import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __text string, doc string, quality string"


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    """(doc_id, text): prose with copies, shared passages, repeated rows, nulls, blanks and a very long text."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeghiklmnoprstuvß") for _ in range(r.randint(2, 9))) for _ in range(300)]

    def prose(k):
        out = []
        for i in range(k):
            w = r.choice(vocabulary)
            out.append(w + r.choice([" ", " ", " ", " ", ". ", ", ", ".\n", "\t"]))
        return "".join(out)

    passage, line = prose(90), prose(30).replace("\n", " ")
    texts: list = [prose(r.choice([3, 4, 5, 20, 60, 150, 300])) for _ in range(n)]
    texts[3] = texts[9] + passage                           # passages that documents share
    texts[11] = passage + texts[11]
    texts[12] = prose(70) + passage + "\n" + prose(70) + passage
    texts[14] = texts[13] = prose(200)                      # exact copies
    texts[15] = texts[13].replace(texts[13].split()[100], "anders", 1)   # a near copy
    texts[16] = prose(3000) + passage + prose(9000)         # a very long text
    texts[17], texts[18], texts[19] = None, "", " \n\t \x0b"
    texts[20] = "a" * 450                                   # overlaps with itself
    texts[21] = "naïve 日本語 \U0001F600 " * 60
    texts[22], texts[23] = line + "\n" + line + "\n" + line, "x\n" + line + "\n" + line + "\n" + line
    texts[24] = texts[25] = "four words are here"
    texts[26] = "\x1c one\x85two\xa0three \x00 four \r\n five"
    for i in range(27, 34):                                 # a group of copies, each with another end
        texts[i] = texts[13] + f" end{i}"
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[13]]                       # repeated rows


def frame(spark, rows, ids_null: bool = True):
    """The rows as a table with extra columns, some named like inner ones; also nulls as ids."""
    langs = ["en", "de", None]
    out = [(i, t, langs[(i or 0) % 3], ["web", "books", None][(i or 0) % 5 % 3], None if t is None else len(t), "x", None, "q")
           for i, t in rows]
    if ids_null:
        out += [(None, "a text without id " * 30, None, None, 1, None, "y", None), (None, "another one", "en", "web", 1, "", "", "")]
    return spark.createDataFrame(out, SCHEMA).repartition(3)


def spans(marks: list[bool]) -> int:
    return sum(m and not (i and marks[i - 1]) for i, m in enumerate(marks))


def repeats(rows, window: int = 200) -> dict:
    """doc_id to (n_bytes, n_removed, n_spans, sha) of the byte-wise substring dedup."""
    count: dict = {}
    raws = [(i, (t or "").encode()) for i, t in rows]
    for _, raw in raws:
        for a in range(len(raw) - window + 1):
            g = raw[a:a + window]
            count[g] = count.get(g, 0) + 1
    out = {}
    for i, raw in raws:
        gone = [False] * len(raw)
        until = 0
        for a in range(len(raw) - window + 1):
            if count[raw[a:a + window]] > 1:
                for j in range(max(a, until), a + window):
                    gone[j] = True
                until = a + window
        out[i] = (len(raw), sum(gone), spans(gone), sha(bytes(b for b, g in zip(raw, gone) if not g)))
    return out


def earlier(rows, window: int = 50) -> dict:
    """doc_id to (n_words, n_removed, sha) of the word-wise dedup against smaller ids."""
    first: dict = {}
    lists = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in lists:
        for a in range(len(w) - window + 1):
            g = tuple(w[a:a + window])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in lists:
        gone: set[int] = set()
        for a in range(len(w) - window + 1):
            if first[tuple(w[a:a + window])] < i:
                gone.update(range(a, a + window))
        out[i] = (len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def shingles(text: str | None, k: int = 5) -> set:
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[a:a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near(rows) -> dict:
    """doc_id to (n_shingles, component_id)."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[n + 1:]:
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x_, y_ = find(x), find(y)
                top[max(x_, y_)] = min(x_, y_)
    return {i: (len(sets[i]), find(i)) for i in ids}


def line_dedup(rows, min_lines: int = 3, min_chars: int = 200) -> dict:
    """doc_id to (n_removed, text): every document aligned with every earlier one."""
    from forumlens.llm import linedup

    texts = {i: t.split("\n") for i, t in rows if t is not None}
    lines = {i: [x.strip(linedup.BLANKS) for x in t] for i, t in texts.items()}
    out = {i: (0, t) for i, t in rows}
    for i, b in lines.items():
        gone: set = set()
        for j, a in lines.items():
            if j < i and set(a) & set(b):
                gone.update(linedup.blocks_to_remove(linedup.patience(a, b), [len(x) for x in b], min_lines, min_chars))
        if gone:
            out[i] = (len(gone), "\n".join(x for n, x in enumerate(texts[i]) if n not in gone))
    return out


def quality_base(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    t = text or ""
    w = WORD.findall(t)
    seen: dict = {}
    for a in range(len(w) - 2):
        seen.setdefault(tuple(w[a:a + 3]), []).append(a)
    covered = {a + k for at in seen.values() if len(at) > 1 for a in at for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))
