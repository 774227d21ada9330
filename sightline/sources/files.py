"""Documents from files (S1, S2, S13): a single JSON document of any size is read by many tasks.

Byte ranges of a file are first summed up apart from each other: whether they hold an odd number of
quotes, and which brackets stay open or close earlier ones, both if they begin outside a string and if
they begin within one. A walk over a file's ranges (some numbers each) then tells each range where it
begins. With that, each range cuts out the members of the root and the elements of its lists that begin
in it, reading past its end for the last one. A small file is summed up and cut in one reading, and stays
one row. Files are UTF-8.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import bank
from ..session import shared_folder, ship, written

RANGE_BYTES = 1 << 26
#: A file of at most so many bytes is cut whole: its parts are one row, of which Spark's writers hold a hundred.
WHOLE_BYTES = 1 << 20
#: Bytes of bodies in a batch of rows.
BATCH_BYTES = 1 << 22
ESCAPE = re.compile(rb"\\.", re.DOTALL)
#: A string, a bracket or a comma; a quote alone where a string does not end in what was read.
TOKEN = re.compile(rb'"[^"]*"|["\[\]{},]')
#: All up to the next bracket outside strings.
HOP = re.compile(rb'[^"\[\]{}]*+(?:"[^"]*+"[^"\[\]{}]*+)*+([\[\]{}])')
NO_BRACKETS = bytes(set(range(256)) - set(b"[]{}"))


def _system(path: str) -> tuple:
    """The file system of a path or URI, and the path within it."""
    from pyarrow import fs

    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class Source:
    """Bytes of one file."""

    def __init__(self, path: str):
        system, at = _system(path)
        self.file = system.open_input_file(at)
        self.size = self.file.size()

    def read(self, start: int, end: int) -> bytes:
        self.file.seek(start)
        return self.file.read(max(0, min(end, self.size) - start))

    def escaped(self, at: int) -> bool:
        """Whether an odd number of backslashes stands before `at`."""
        back = 64
        while True:
            before = self.read(max(0, at - back), at)
            run = len(before) - len(before.rstrip(b"\\"))
            if run < len(before) or back >= at:
                return run % 2 == 1
            back *= 2


class Held(Source):
    """Bytes of a file that is read already."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, start: int, end: int) -> bytes:
        return self.data[start:end]


def masked(piece: bytes, escaped: bool = False) -> bytes:
    """The same bytes without escapes; one cut off at the end stays."""
    if not escaped and b"\\" not in piece:
        return piece
    out = ESCAPE.sub(b"__", (b"\\" if escaped else b"") + piece)
    return out[1:] if escaped else out


def unmatched(parts: list[bytes]) -> bytes:
    """Brackets of the parts without those that match among themselves."""
    left = b"".join(parts).translate(None, NO_BRACKETS)
    size = -1
    while size != len(left):
        size = len(left)
        left = left.replace(b"[]", b"").replace(b"{}", b"")
    return left


def summary(data: bytes, escaped: bool) -> tuple[int, str, str, bool]:
    """(odd, outside, within, brackets): parity of quotes, unmatched brackets if the range begins outside or within a string, whether there are any."""
    parts = masked(data, escaped).split(b'"')
    return (len(parts) - 1) % 2, unmatched(parts[::2]).decode(), unmatched(parts[1::2]).decode(), bool(data.translate(None, NO_BRACKETS))


def walk(ranges: pd.DataFrame) -> pd.DataFrame:
    """Where each range of a file begins: within a string or not, and the open brackets; `error` says what is wrong with the file."""
    states, error = _walked(zip(ranges["odd"], ranges["outside"], ranges["within"]), any(ranges["brackets"]))
    out = ranges[["path", "start", "end"]].copy()
    out["within"], out["kinds"], out["depth"] = ([s[k] for s in states] for k in range(3))
    return out.assign(error=error)


def _walked(sums: Iterable[tuple[int, str, str]], brackets: bool) -> tuple[list[tuple[bool, str, int]], str | None]:
    """(states, error) of a file by (odd, outside, within) of its ranges."""
    within, stack, states, error = False, "", [], None
    for odd, outside, inside in sums:
        states.append((within, stack[:2], len(stack)))
        for bracket in inside if within else outside:
            if bracket in "[{":
                stack += bracket
            elif stack and stack[-1] + bracket in ("[]", "{}"):
                stack = stack[:-1]
            else:
                error = error or f"a {bracket} that closes nothing"
                stack = stack[:-1]
        within ^= bool(odd)
    if error is None and (within or stack):
        error = "the file ends within a string" if within else f"the file ends with {stack[:9]} open"
    if error is None and not brackets:
        error = "no object or list"
    return states, error


def pieces(source: Source, start: int, end: int, within: bool, kinds: str, depth: int, step: int = RANGE_BYTES) -> Iterator[tuple]:
    """(what, key, place, body) of what begins in a range: `member` of the root, `list` of a key, `element` of it.

    A list's key and its elements' places are null where the list began before the range; a root list has the key "".
    """
    data, read = source.read(start, end), end
    plain = masked(data, source.escaped(start))
    at = kept = 0
    if within:
        quote = plain.find(b'"')
        if quote < 0:
            return
        at = quote + 1
    key, place, element, member, name = None, None, None, None, None
    level = (1 if kinds[0] == "[" else 2) if kinds else 0
    hops = True
    while True:
        # Within an element, or a member's object, only brackets tell anything.
        nested = level > 0 and (depth > level or kinds == "{{")
        token = HOP.match(plain, at) if nested and hops else None
        if token is not None:
            here, at = token.start(1), token.end()
            sign = plain[here:at]
        else:
            # Where no bracket follows in what was read, it is not looked for again before more is read.
            hops = hops and not nested
            token = TOKEN.search(plain, at)
            if token is None or (token.group() == b'"'):
                if element is None and member is None and (token is None or start + token.start() >= end):
                    return
                more = source.read(read, read + step)
                if not more:
                    return
                cut = len(plain) - len(plain.rstrip(b"\\")) == 1
                data, plain, read = data + more, (plain[:-1] + masked(b"\\" + more) if cut else plain + masked(more)), read + len(more)
                hops = True
                continue
            at, sign, here = token.end(), token.group(), token.start()
        own = start + here < end
        if len(sign) > 1:
            if depth == 1 and level == 2 and member is not None and name is None:
                name = _text(data[here:at])
            continue
        if sign in b"[{":
            depth += 1
            if depth <= 2:
                kinds = kinds[: depth - 1] + sign.decode()
            if depth == 1:
                level = 1 if sign == b"[" else 2
                if level == 2 and own:
                    member, name = here + 1, None
            if depth == level and sign == b"[":
                # A list is no member: whoever has its key tells it, and its elements are rows of their own.
                key, place = None, None
                if level == 1 and own or member is not None:
                    key, place = ("" if level == 1 else name), 0
                    yield "list", key, None, None
                member, element = None, here + 1 if own else None
        elif sign == b",":
            if depth == level and kinds[level - 1 : level] == "[":
                if element is not None:
                    yield "element", key, place, data[element:here]
                    place = None if place is None else place + 1
                element = here + 1 if own else None
            elif depth == 1 and level == 2:
                if member is not None and name is not None:
                    yield "member", name, None, _value(data[member:here])
                member, name = (here + 1, None) if own else (None, None)
        else:
            if depth == level and kinds[level - 1 : level] == "[" and element is not None:
                # Only blanks before the end: an empty list, or a comma too many.
                if data[element:here].strip():
                    yield "element", key, place, data[element:here]
                element = None
            if depth == 1 and level == 2 and member is not None and name is not None:
                yield "member", name, None, _value(data[member:here])
                member = None
            depth -= 1
            kinds = kinds[:depth]
            level = level if depth else 0
        if not own and element is None and member is None:
            return


def _text(literal: bytes) -> str:
    """What a JSON string says; one with odd escapes stays as it is spelt."""
    spelt = literal.decode("utf-8", "replace")
    try:
        return json.loads(spelt, strict=False)
    except ValueError:
        return spelt[1:-1]


def _value(member: bytes) -> bytes:
    """What follows the key and colon of a member."""
    key = TOKEN.search(masked(member))
    return member[key.end() :].partition(b":")[2]


SUMS = "path string, start long, end long, odd long, outside string, within string, brackets boolean"
#: `line` counts the rows of a range, `seq` the elements before a row in it.
CUT = "path string, start long, line long, seq long, what string, key string, place long, body string"
#: A file's parts in its order, and what is wrong with it.
WHOLE = "path string, parts array<struct<what: string, key: string, place: long, body: string>>, error string"


def write_files(rows: DataFrame) -> DataFrame:
    """Write each row (name, body) to a file of its own in the shared folder; (path, length) of each. No name holds a slash, and none occurs twice.

    An attempt of a task writes into a folder of its own, so what a lost one left is not among the files returned.
    """
    ship(rows.sparkSession)
    folder = f"{shared_folder(rows.sparkSession)}/documents-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = f"{folder}/{uuid.uuid4().hex}"
        system, at = _system(own)
        system.create_dir(at, recursive=True)
        for batch in batches:
            paths, lengths = [], []
            for name, body in zip(*batch.columns):
                data = (body.as_py() or "").encode()
                with system.open_output_stream(f"{at}/{name}", compression=None) as out:
                    out.write(data)
                paths.append(f"{own}/{name}")
                lengths.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], names=["path", "length"])

    return written(rows.select("name", "body").mapInArrow(run, "path string, length long"), "files")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `WHOLE` of files(path), each summed up and cut in one reading."""
    paths, errors, ends, parts, size = [], [], [0], [], 0

    def rows() -> pa.RecordBatch:
        columns = list(zip(*parts)) if parts else [()] * 4
        names = ("what", "key", "place", "body")
        fields = [pa.array(c, pa.int64() if n == "place" else pa.string()) for n, c in zip(names, columns)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, names))
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), lists, pa.array(errors, pa.string())], names=["path", "parts", "error"])

    for batch in batches:
        for path in batch.column(0).to_pylist():
            file = Source(path)
            source = Held(file.read(0, file.size))
            *sums, brackets = summary(source.data, False)
            errors.append(_walked([sums], brackets)[1])
            for what, key, place, body in pieces(source, 0, source.size, False, "", 0):
                parts.append((what, key, place, None if body is None else body.decode("utf-8", "replace").strip()))
            paths.append(path)
            ends.append(len(parts))
            size += source.size + 100 * (ends[-1] - ends[-2])
            if size > BATCH_BYTES:
                yield rows()
                paths, errors, ends, parts, size = [], [], [0], [], 0
    if paths:
        yield rows()


def _cut(spark: SparkSession, path: str | DataFrame, range_bytes: int) -> tuple[DataFrame, tuple[DataFrame, DataFrame] | None]:
    """(whole, ranged): rows of `WHOLE` for small files, not kept, and (parts, errors) of the others by byte ranges, None where there are none."""
    ship(spark)
    # Only names and lengths are read here.
    files = path if isinstance(path, DataFrame) else spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    size, longest = (n or 0 for n in files.agg(F.sum("length"), F.max("length")).first())
    # About a range of bytes a task, however many files they lie in.
    count = max(spark.sparkContext.defaultParallelism, min(size // range_bytes + 1, 100_000))
    most = min(range_bytes, WHOLE_BYTES)
    whole = files.where(F.col("length") <= most).select("path").repartition(count).mapInArrow(_whole, WHOLE)
    return whole, None if longest <= most else _ranged(files.where(F.col("length") > most), range_bytes, count)


def _ranged(files: DataFrame, range_bytes: int, count: int) -> tuple[DataFrame, DataFrame]:
    """(parts, errors) of files(path, length) by byte ranges, in `count` tasks."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = files.select("path", F.explode(starts).alias("start"), "length").select("path", "start", F.least(F.col("start") + range_bytes, "length").alias("end"))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                source = Source(name)
                found = (name, start, end, *summary(source.read(start, end), source.escaped(start)))
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in found], names=SUMS.replace(",", "").split()[::2])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start, end, within, kinds, depth in zip(*(c.to_pylist() for c in batch.columns)):
                held, size, seq = [], 0, 0
                for line, (what, key, place, body) in enumerate(pieces(Source(name), start, end, within, kinds, depth)):
                    text = None if body is None else body.decode("utf-8", "replace").strip()
                    held.append({"path": name, "start": start, "line": line, "seq": seq, "what": what, "key": key, "place": place, "body": text})
                    seq, size = seq + (what == "element"), size + len(body or b"") + 100
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in CUT.split(", "))])
    sums = ranges.repartition(count).mapInArrow(summed, SUMS)
    walked = written(
        sums.groupBy("path").applyInPandas(
            lambda rows: walk(rows.sort_values("start")), "path string, start long, end long, within boolean, kinds string, depth int, error string"
        ), "json-ranges"
    )
    errors = walked.where("error IS NOT NULL").select("path", "error").distinct()
    # Kept, as the files are read here and the rows twice.
    found = written(walked.select("path", "start", "end", "within", "kinds", "depth").repartition(count).mapInArrow(cut, CUT), "json-parts")
    # A row for each range: its elements, and its last list.
    last = F.max_by(F.when(F.col("what") == "list", F.struct("key", "seq")), F.when(F.col("what") == "list", F.col("line")))
    per = found.groupBy("path", "start").agg(F.count_if(F.col("what") == "element").alias("n"), last.alias("last"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    opened = F.when(F.col("last").isNotNull(), F.struct(F.col("last.key").alias("key"), (F.col("base") + F.col("last.seq")).alias("at")))
    per = per.withColumn("opened", opened).withColumn("opened", F.last("opened", ignorenulls=True).over(earlier))
    rows = found.join(per.select("path", "start", "base", "opened"), ["path", "start"])
    goes_on = (F.col("what") == "element") & F.col("place").isNull()
    parts = rows.select(
        "path", "what", F.when(goes_on, F.col("opened.key")).otherwise(F.col("key")).alias("key"),
        F.when(goes_on, F.col("base") + F.col("seq") - F.col("opened.at")).otherwise(F.col("place")).alias("place"), "body", "start", "line"
    )
    return parts, errors


def json_parts(spark: SparkSession, path: str | DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(parts, errors) of the JSON files at `path`: a file, folder or pattern, or a table (path, length) of files.

    parts(path, what, key, place, body, start, line): a row for each member of a root object that is no list, each list
    (without a body) and each element of such a list, with its place from 0; the elements of a root list have the key "".
    errors(path, error): files whose brackets or strings don't match. Parts of those are what could be cut out.
    A byte order mark is skipped; files without a byte are not listed.
    """
    whole, ranged = _cut(spark, path, range_bytes)
    whole = written(whole, "json-files")
    parts = whole.select("path", F.posexplode("parts").alias("line", "x")).select(
        "path", "x.*", F.lit(0).cast("long").alias("start"), F.col("line").cast("long").alias("line")
    )
    errors = whole.where("error IS NOT NULL").select("path", "error")
    return (parts, errors) if ranged is None else (parts.unionByName(ranged[0]), errors.unionByName(ranged[1]))


#: A file's name without its folders and last suffix.
NAME = r"([^/]+?)(?:\.[^./]*)?$"


def _named(pattern: str) -> Column:
    return F.regexp_extract("path", pattern, 1)


def _around(head: str, tail: str) -> Column:
    return F.concat(F.lit(head), "body", F.lit(tail))


def _member(part: Column | None = None) -> Column:
    """A member of a root object as JSON."""
    key, body = (F.col(n) if part is None else part[n] for n in ("key", "body"))
    return F.concat(F.regexp_replace(F.to_json(F.struct(key.alias("k"))), r'^\{"k":(.*)\}$', "$1"), F.lit(": "), body)


def read_crawls(spark: SparkSession, path: str | DataFrame, range_bytes: int = RANGE_BYTES, name: str = NAME) -> tuple[DataFrame, DataFrame]:
    """(raw, errors): crawls of files as `ingest` reads them, a document for each sample, result and planned sample; `name` finds the run in a file's path.

    raw(run_id, body, offset) holds each element in a document of its own, with its place in the file's list. A root
    object without samples and results is one result, and is put together again.
    """
    parts, errors = json_parts(spark, path, range_bytes)
    held = lambda key: F.max(F.coalesce((F.col("what") == "list") & (F.col("key") == key), F.lit(False)))
    shapes = parts.groupBy("path").agg(held("samples").alias("batch"), held("results").alias("results"), held("").alias("rooted"))
    rows = parts.join(shapes, "path")
    element = F.col("what") == "element"
    body = (
        F.when(F.col("batch") & element & (F.col("key") == "samples"), _around('{"samples": [', "]}"))
        .when(F.col("batch") & element & (F.col("key") == "plan"), _around('{"samples": [], "plan": [', "]}"))
        .when(~F.col("batch") & F.col("results") & element & (F.col("key") == "results"), _around('{"results": [', "]}"))
        .when(F.col("rooted") & element & (F.col("key") == ""), _around("[", "]"))
    )
    several = rows.select(_named(name).alias("run_id"), body.alias("body"), F.col("place").alias("offset")).where("body IS NOT NULL")
    single = rows.where("NOT batch AND NOT results AND NOT rooted")
    raw = several.unionByName(_joined(single).select(_named(name).alias("run_id"), "body", F.lit(0).cast("long").alias("offset")))
    # Kept, as an import reads it for samples, for plans and for what is missing.
    return written(raw, "json-crawls"), errors


def _joined(rows: DataFrame) -> DataFrame:
    """(path, body) of root objects put together from their parts."""
    members = rows.where("what = 'member'").select("path", _member().alias("m"))
    lists = rows.where("what != 'member'").groupBy("path", "key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("what") == "element", F.struct("place", "body")))), lambda e: e["body"]), ", ").alias("body")
    )
    both = members.unionByName(lists.withColumn("body", _around("[", "]")).select("path", _member().alias("m")))
    return both.groupBy("path").agg(_around_all().alias("body"))


def _around_all(members: Column | None = None) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list("m") if members is None else members), ", "), F.lit("}"))


def read_questions(spark: SparkSession, path: str | DataFrame, range_bytes: int = RANGE_BYTES, name: str = NAME) -> tuple[DataFrame, DataFrame]:
    """(raw, errors) of question banks as `ingest.import_questions` reads them, a document for each question; `name` finds the run in a file's path."""
    parts, errors = json_parts(spark, path, range_bytes)
    rows = parts.where("what = 'element' AND key IN ('questions', '')")
    return rows.select(_named(name).alias("run_id"), _around('{"questions": [', "]}").alias("body"), F.col("place").alias("offset")), errors


def _listed(what: Column, key: Column) -> Column:
    """The list of questions, which are read apart from their bank."""
    return F.when((what == "list") & (key == "questions"), F.lit('"questions": []'))


def read_banks(spark: SparkSession, path: str | DataFrame, range_bytes: int = RANGE_BYTES, name: str = NAME) -> tuple[bank.Bank, DataFrame]:
    """(bank, errors): tables of question banks from files, as `json_parts` takes them; `name` finds the bank in a file's path.

    All but the questions is one document; other lists of a root are not read. Questions of a small file stay in one
    row with it, and nothing is shuffled for them; those of another are read by many tasks and joined to their bank.
    """
    whole, ranged = _cut(spark, path, range_bytes)
    members = F.filter(F.transform("parts", lambda p: F.when(p["what"] == "member", _member(p)).otherwise(_listed(p["what"], p["key"]))), lambda m: m.isNotNull())
    elements = F.filter("parts", lambda p: (p["what"] == "element") & (p["key"] == "questions"))
    each = F.transform(elements, lambda p: F.struct((p["place"] + 1).cast("int").alias("row_no"), p["body"].alias("body")))
    # Kept, as the files are read here and the rows several times.
    held = written(whole.select("path", "error", _named(name).alias("bank_id"), _around_all(members).alias("body"), each.alias("asked")), "json-banks")
    errors = held.where("error IS NOT NULL").select("path", "error")
    docs = held.select("bank_id", "body", "asked")
    if ranged is not None:
        parts = ranged[0].withColumn("bank_id", _named(name))
        shell = parts.where("what != 'element'").withColumn("m", F.when(F.col("what") == "member", _member()).otherwise(_listed(F.col("what"), F.col("key"))))
        docs = docs.unionByName(shell.groupBy("bank_id").agg(_around_all().alias("body")), allowMissingColumns=True)
        errors = errors.unionByName(ranged[1])
    loaded = bank.load(docs)
    # Each question is parsed once, for itself and for its fields.
    parsed = F.transform("asked", lambda a: F.struct(a["row_no"].alias("row_no"), F.try_parse_json(a["body"]).alias("q")))
    fields = F.transform(parsed, lambda a: F.struct(a["row_no"].alias("row_no"), a["q"].alias("q"), _fields(a["q"]).alias("fields")))
    rows = bank.carried(loaded.config, "asked").select("*", F.explode(fields).alias("x")).select("*", "x.*").drop("asked", "x")
    config = loaded.config.withColumn("questions", F.size("asked"))
    if ranged is not None:
        asked = parts.where("key = 'questions' AND what = 'element'").select("bank_id", (F.col("place") + 1).cast("int").alias("row_no"), F.try_parse_json("body").alias("q"))
        apart = loaded.config.where("asked IS NULL")
        rows = rows.unionByName(asked.withColumn("fields", _fields(F.col("q"))).join(bank.carried(apart), "bank_id"))
        counts = asked.groupBy("bank_id").agg(F.count("*").cast("int").alias("n"))
        config = loaded.config.join(counts, "bank_id", "left").withColumn("questions", F.coalesce(F.when(F.col("asked").isNotNull(), F.size("asked")), "n", F.lit(0))).drop("n")
    return loaded._replace(rows=rows, config=config.drop("asked")), errors


def _fields(q: Column) -> Column:
    return F.try_variant_get(q, "$", "map<string,string>")
