"""Records of text files that many tasks read, where a record may run over line ends.

Spark's text source deals the lines of a large file to many tasks (blocks). A CSV value in
quotes or an XML element may hold line ends, so a block can start or end inside a record.

* CSV: whether a block starts inside quotes depends on all quotes before it. One pass
  gives each block's effect on that state, for both states it may start in (one small row per block);
  running through these rows gives every block's true state. A second pass then reads all
  blocks at once, each from its known state. A record that crosses a border is put together from
  the tail of one block, whole blocks perhaps, and the head of another; these pieces alone are
  shuffled, and looked for only if a block does start inside quotes.
* XML rows: ``<`` cannot stand in an attribute's value, so each ``<row`` starts an element whatever
  the state. With one row a line no state is needed; for rows over several lines the text behind a block's last ``<`` is its open
  tail, and the text before the next block's first ``<`` belongs to it.

Line ends are ``\\n`` (a ``\\r`` before it is part of the line end); text is UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = "file long, block long, start boolean, text string, ends boolean"


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, block, line): every line with the hash of its file's path and where its block starts."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"))


def _blocks(batches) -> Iterator[tuple[int, int, bool, pa.Array]]:
    """(file, block, whether it is the block's first piece, lines) for runs of lines of one block, in order."""
    before = None
    for batch in batches:
        files, starts = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        a = 0
        while a < len(files):
            same = (files[a:] == files[a]) & (starts[a:] == starts[a])
            b = a + (int(same.argmin()) if not same.all() else len(same))
            key = (int(files[a]), int(starts[a]))
            yield *key, key != before, batch.column("line").slice(a, b - a)
            before, a = key, b


# ------------------------------------------------------------------ CSV
def _odd(column: pa.Array) -> pa.Array:
    """1 for each line with an odd number of quotes."""
    return pc.bit_wise_and(pc.count_substring(column, '"'), 1)


class _Quotes:
    """Follows lines from a known state: ``inside`` quotes or between records."""

    def __init__(self, inside: bool, comment: str | None):
        self.inside, self.comment = inside, comment
        self.held: list[str] = []          # lines of the record that is open
        self.from_before = inside          # whether that record started before the block

    def records(self, column: pa.Array) -> Iterator[tuple[bool, str]]:
        """(whether it started before the block, record) for each record that ends in these lines."""
        for line, turns in zip(column.to_pylist(), _odd(column).to_pylist()):
            if not self.inside and not self.held:
                if self.comment and line.startswith(self.comment):
                    continue
                if not turns:
                    yield False, line[:-1] if line.endswith("\r") else line
                    continue
            self.held.append(line)
            self.inside ^= bool(turns)
            if not self.inside:
                text = "\n".join(self.held)
                yield self.from_before, text[:-1] if text.endswith("\r") else text
                self.held, self.from_before = [], False

    def plain(self, column: pa.Array) -> pa.Array | None:
        """The records of these lines if each line is one as it stands, without a loop over them; else None."""
        if (self.inside or self.held or pc.any(pc.ends_with(column, "\r")).as_py()
                or pc.any(pc.equal(_odd(column), 1)).as_py()):
            return None
        kept = pc.not_equal(column, "")
        if self.comment:
            kept = pc.and_not(kept, pc.starts_with(column, self.comment))
        return column.filter(kept).cast(pa.string())

    def turn(self, column: pa.Array, odd: pa.Array) -> None:
        """Follow the lines without their records; ``odd`` tells which hold an odd number of quotes."""
        comments = pc.starts_with(column, self.comment) if self.comment else None
        if comments is None or not pc.any(pc.and_(comments, pc.equal(odd, 1))).as_py():
            self.inside ^= bool((pc.sum(odd).as_py() or 0) % 2)
            return
        for turns, skipped in zip(odd.to_pylist(), comments.to_pylist()):
            if self.inside or not skipped:
                self.inside ^= bool(turns)


def _csv_states(table: DataFrame, comment: str | None) -> tuple[set[tuple[int, int]], bool, list[str]]:
    """Blocks that start inside quotes, whether a file ends inside, and the different headers of the files."""
    def effect(batches):
        out: list = []
        for file, block, new, column in _blocks(batches):
            if new:
                out.append([file, block, _Quotes(False, comment), _Quotes(True, comment), None, _Quotes(False, comment)])
            last = out[-1]
            odd = _odd(column)
            last[2].turn(column, odd)
            last[3].turn(column, odd)
            if block == 0 and last[4] is None:
                last[4] = next((text for _, text in last[5].records(column) if text), None)
        for file, block, a, b, first, _ in out:
            yield pa.RecordBatch.from_pydict({"file": [file], "block": [block], "after_out": [a.inside], "after_in": [b.inside],
                                              "first": pa.array([first], pa.string())})

    rows = table.mapInArrow(effect, "file long, block long, after_out boolean, after_in boolean, first string").collect()
    inside, open_end, state, before = set(), False, False, None
    for r in sorted(rows, key=lambda r: (r["file"], r["block"])):
        if r["file"] != before:
            open_end, state, before = open_end or state, False, r["file"]
        if r["block"] == 0 and r["first"] is None and r["after_out"]:
            raise ValueError("a header that does not end in the first block of its file")
        if state:
            inside.add((r["file"], r["block"]))
        state = r["after_in"] if state else r["after_out"]
    return inside, open_end or state, sorted({r["first"].removeprefix("\ufeff") for r in rows if r["first"]})


def csv_records(spark: SparkSession, paths: str | Sequence[str], comment: str | None = None) -> tuple[DataFrame, str | None]:
    """(frame with the columns ``file``, a hash of its path, and ``record``; the header that all files share).

    Blank lines and, between records, lines that start with ``comment`` are skipped. Files whose
    headers differ raise. A quote may only stand in a value that is in quotes.
    """
    table = lines(spark, paths)
    inside, open_end, headers = _csv_states(table, comment)
    if len(headers) > 1:
        raise ValueError(f"files with different headers: {headers[:3]}")

    def walk(batches):
        """(file, block, its quotes, lines or None at the block's end)."""
        key, quotes = (0, 0), None
        for file, block, new, column in _blocks(batches):
            if new:
                if quotes is not None:
                    yield *key, quotes, None
                key, quotes = (file, block), _Quotes((file, block) in inside, comment)
            yield file, block, quotes, column
        if quotes is not None:
            yield *key, quotes, None

    def records(batches):
        header = None               # whether the block's first record is still to come, and is a header
        for file, block, quotes, column in walk(batches):
            if column is None:
                header = None
                continue
            header = block == 0 if header is None else header
            whole = quotes.plain(column)
            if whole is None:
                whole = pa.array([text for before, text in quotes.records(column) if text and not before], pa.string())
            if header and len(whole):
                whole, header = whole.slice(1), False
            if len(whole):
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file, pa.int64()), len(whole)), whole], names=["file", "record"])

    def pieces(batches):
        """What block borders cut: heads that belong to the block before, and open tails."""
        for file, block, quotes, column in walk(batches):
            if column is not None:
                heads = [text for before, text in quotes.records(column) if before]
                if heads:
                    yield _piece(file, block, False, heads[0], True)
            elif quotes.held:
                yield _piece(file, block, not quotes.from_before, "\n".join(quotes.held), False)

    found = table.mapInArrow(records, "file long, record string")
    if inside or open_end:
        found = found.unionByName(_joined(table.mapInArrow(pieces, PIECE), "\n").withColumnRenamed("text", "record"))
    return found, headers[0] if headers else None


def _piece(file: int, block: int, start: bool, text: str, ends: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"file": [file], "block": [block], "start": [start], "text": [text], "ends": [ends]})


def _joined(pieces: DataFrame, between: str) -> DataFrame:
    """The texts that cross block borders: a starting piece and those after it up to one that ends, or to the
    end of the file. There are at most two pieces a block; a task holds one text at a time."""
    def join(batches):
        held: list[str] = []
        file = None
        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["start"] or r["file"] != file):
                    yield pa.RecordBatch.from_pydict({"file": [file], "text": [between.join(held)]})
                    held = []
                file = r["file"]
                if held or r["start"]:
                    held.append(r["text"])
                if held and r["ends"]:
                    yield pa.RecordBatch.from_pydict({"file": [file], "text": [between.join(held)]})
                    held = []
        if held:
            yield pa.RecordBatch.from_pydict({"file": [file], "text": [between.join(held)]})

    return pieces.repartition("file").sortWithinPartitions("file", "block", "start").mapInArrow(join, "file long, text string")


# ------------------------------------------------------------------ XML
def element_pattern(tag: str) -> str:
    """A start tag or empty element with its attributes (same meaning in Java and Python)."""
    return rf"""<{re.escape(tag)}(?:\s+[^\s=<>"'/]+\s*=\s*(?:"[^"<]*"|'[^'<]*'))*\s*/?>"""


def plain_pattern(tag: str) -> str:
    """An element (group 1) alone in its line that needs no XML parser: values in double quotes, one space before each
    name, no = at the end of a value, no references but the five named entities, no name that may be a namespace's (Java)."""
    return rf"""^[ \t]*+(<{re.escape(tag)}(?: (?![xX][mM][lL])[A-Za-z_][A-Za-z0-9_]*+={_plain_value()}")++ *+/?>)[ \t\r]*+(?:</{re.escape(tag)}>[ \t\r]*+)?\z"""


def _plain_value() -> str:
    """A value of :func:`plain_pattern` and the quote before it."""
    # characters one by one: Java looks them up in a table, ranges in a negated class are tried one after the other
    control = "".join(rf"\x{i:02X}" for i in (*range(0x20), *range(0x7F, 0xA0)))
    text = rf'[^"<&{control}]*+'
    return rf'"{text}(?:&(?:amp|lt|gt|quot|apos);{text})*+(?<!=)'


def ordered_pattern(tag: str, names: Sequence[str]) -> str | None:
    """What :func:`plain_pattern` finds if its attributes are some of ``names`` in this order, as a dump has them. Group
    i is the value of name i behind a quote, or empty without that attribute. None if the names do not go with it (Java)."""
    if not names or len({n.lower() for n in names}) < len(names) or not all(re.fullmatch("(?![xX][mM][lL])[A-Za-z_][A-Za-z0-9_]*", n) for n in names):
        return None
    attributes = "".join(rf'(?: {n}=({_plain_value()})")?+' for n in names)
    return rf"""^[ \t]*+<{re.escape(tag)}(?= [A-Za-z_]){attributes} *+/?>[ \t\r]*+(?:</{re.escape(tag)}>[ \t\r]*+)?\z"""


def decoded(text: Column) -> Column:
    """``text`` with the characters for the five named entities."""
    out = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(text.contains("&"), out).otherwise(text)


def xml_elements(spark: SparkSession, paths: str | Sequence[str], tag: str = "row", rows_span_lines: bool = False,
                 names: Sequence[str] = (), wanted: Sequence[str] = ()) -> DataFrame:
    """Columns ``element``, the text of each start tag or empty element ``tag``, and ``plain``: it is one of :func:`plain_pattern`.

    With ``wanted``, some of ``names``, there is a third, ``values``: for an element of :func:`ordered_pattern` an empty text,
    then the groups of the wanted names, without entities; else NULL. Where it is not NULL, ``element`` is empty.

    Rows that lie in one line each are found by expressions alone; a row that does not end in
    its line raises, unless ``rows_span_lines``.
    """
    if not rows_span_lines:
        # the place of a line in its file is of no use here, and costs more than the line
        table = spark.read.option("lineSep", "\n").text([paths] if isinstance(paths, str) else list(paths)).select(F.col("value").alias("line"))
        possessive = element_pattern(tag).replace("+", "++").replace("*", "*+")
        found = F.regexp_extract_all("line", F.lit(possessive), F.lit(0))
        starts = F.size(F.split("line", rf"<{re.escape(tag)}(?=[\s/>]|$)", -1)) - 1
        broken = F.raise_error(F.concat(F.lit("a row runs over line ends, read with rows_span_lines=True: "), F.substring("line", 1, 200)))
        checked = F.when(starts == F.size(found), found).otherwise(F.array(broken.cast("string")))
        sound = F.is_valid_utf8("line") & ~F.contains("line", F.lit("\uFFFE")) & ~F.contains("line", F.lit("\uFFFF"))
        ordered, values = ordered_pattern(tag, names), F.lit(None).cast("array<string>")
        if ordered and wanted:
            # a line that is not of the pattern stays as it is, and a control character at its start is none of the marks
            marks = F.regexp_replace("line", F.lit(ordered), F.lit("".join(f"\x02${list(names).index(n) + 1}" for n in wanted)))
            table = table.select("line", F.when(sound & ~F.startswith("line", F.lit("\x02")), marks).alias("marks"))
            # all values at once: with an expression for each, the code for a wide table is too large to be compiled
            values = F.when(F.startswith("marks", F.lit("\x02")), F.split(decoded(F.col("marks")), "\x02", -1))
        table = table.select("line", values.alias("values"))
        lone = table.select("line", "values", F.when(F.col("values").isNull() & sound, F.regexp_extract("line", plain_pattern(tag), 1)).otherwise("").alias("lone"))
        # an outer explode: for an inner one the optimizer adds a filter that finds the elements once more
        return lone.select(F.explode_outer(F.when(F.col("values").isNotNull(), F.array(F.lit(""))).when(F.col("lone") != "", F.array("lone"))
                                           .otherwise(checked)).alias("element"),
                           (F.col("lone") != "").alias("plain"), *(["values"] if wanted else [])).where("element IS NOT NULL")

    table = lines(spark, paths)
    pattern = re.compile(element_pattern(tag))
    start = re.compile(rf"<{re.escape(tag)}(?=[\s/>]|$)")

    def walk(batches) -> Iterator[tuple]:
        """(key, texts from one ``<`` to the next) and, when a block ends, (key, head, tail, whether it has a ``<``)."""
        key, head, held, seen = None, "", "", False
        for file, block, new, column in _blocks(batches):
            if new:
                if key is not None:
                    yield key, None, head, held, seen
                key, head, held, seen = (file, block), "", "", False
            text = held + "\n".join(column.to_pylist()) + "\n"
            parts = text.split("<")
            if not seen:
                if len(parts) == 1:
                    held = text
                    continue
                head, seen = parts[0], True
            yield key, ["<" + p for p in parts[1:-1]], None, None, None
            held = "<" + parts[-1]
        if key is not None:
            yield key, None, head, held, seen

    def whole(batches):
        for _, texts, _, tail, seen in walk(batches):
            texts = texts if texts is not None else [tail] if seen else []
            rows = [m.group() for m in map(pattern.match, texts) if m]
            if rows:
                yield pa.RecordBatch.from_pydict({"element": pa.array(rows, pa.string())})

    def pieces(batches):
        for (file, block), texts, head, tail, seen in walk(batches):
            if texts is not None:
                continue
            if not seen:
                yield _piece(file, block, False, tail, False)
                continue
            if head.strip():
                yield _piece(file, block, False, head, True)
            if start.match(tail) and not pattern.match(tail):
                yield _piece(file, block, True, tail, False)

    crossing = _joined(table.mapInArrow(pieces, PIECE), "")
    text = F.regexp_extract("text", element_pattern(tag).replace("+", "++").replace("*", "*+"), 0)
    return table.mapInArrow(whole, "element string").unionByName(
        crossing.select(F.when(text == "", F.raise_error(F.concat(F.lit("a row without an end: "), F.substring("text", 1, 200))).cast("string"))
                        .otherwise(text).alias("element"))).select(
        "element", F.lit(False).alias("plain"), *([F.lit(None).cast("array<string>").alias("values")] if wanted else []))


def attribute_names(elements: DataFrame) -> list[str]:
    """All attribute names, in alphabetical order; they are few whatever the number of rows."""
    name = F.explode(F.regexp_extract_all("element", F.lit(r"""\s([^\s=<>"'/]++)\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+')"""), F.lit(1))).alias("name")
    return sorted(r["name"] for r in elements.select(name).distinct().collect())
