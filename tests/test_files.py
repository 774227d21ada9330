"""Documents cut out of files, at every border of ranges, against the library's parser."""

import json
import random

import pandas as pd
import pytest
from test_answers import CRAWL, questions, raw
from pyspark.sql import functions as F
from test_bank_and_grounding import load, valid

from sightline.operators import bank
from sightline.plans import banks, registry
from sightline.sources import files, ingest

ODD = {
    "run": {"id": 'a "b" \\ [', "n": [1, {"x": "}"}]}, "samples": [{"a": "]}\\\"", "b": [[], {}]}, "junk", 7, None, {"é🙂": "\\u00e9\\\\"}, [], [[1, 2], "x,y"]], "plan": [], "t": "x\\",
    "results": [{"k": "v" * 40}], "z": None, "e": {}, "last": 1.5
}


def plain(document):
    """Members, lists and elements as rows."""
    if isinstance(document, list):
        return [("list", "", None, None)] + [("element", "", k, e) for k, e in enumerate(document)]
    out = []
    for key, value in document.items():
        if isinstance(value, list):
            out += [("list", key, None, None)] + [("element", key, k, e) for k, e in enumerate(value)]
        else:
            out.append(("member", key, None, value))
    return out


class Held(files.Source):
    def __init__(self, data):
        self.data, self.size = data, len(data)

    def read(self, start, end):
        return self.data[start:end]


def cut(data, step):
    source, rows = Held(data), []
    for start in range(0, max(1, len(data)), step):
        end = min(start + step, len(data))
        rows.append(("p", start, end, *files.summary(source.read(start, end), source.escaped(start))))
    walked = files.walk(pd.DataFrame(rows, columns=["path", "start", "end", "odd", "outside", "within", "brackets"]))
    out, key, at = [], None, 0
    for r in walked.itertuples():
        for what, own, place, body in files.pieces(source, r.start, r.end, r.within, r.kinds, r.depth, step=5):
            if what == "list":
                key, at = own, 0
            if what == "element":
                assert (own, place) in ((key, at), (None, None), (key, None)) or own is None
                own, place, at = key, at, at + 1
            out.append((what, own, place, None if body is None else json.loads(body)))
    return out, walked["error"].iloc[0]


@pytest.mark.parametrize("document", [ODD, [ODD, 1, "x", []], {}, [], {"a": []}, {"samples": [{"a": [1, 2]}]}], ids=range(6))
@pytest.mark.parametrize("spelling", [{}, {"indent": 3, "ensure_ascii": False}, {"separators": (",", ":")}], ids=range(3))
def test_every_border(document, spelling):
    data = json.dumps(document, **spelling).encode()
    for step in [*range(1, 60), len(data), len(data) + 9]:
        assert cut(data, step) == (plain(document), None)


def test_random_documents():
    rng = random.Random(5)

    def value(depth):
        kind = rng.randrange(7 if depth else 4)
        if kind < 4:
            return rng.choice([1, None, "", '"\\', "\\\\\"", "[{,", "}]:", "é", True, "\n\t"])
        return [value(depth - 1) for _ in range(rng.randrange(4))] if kind < 6 else {rng.choice('ab"\\{') + str(k): value(depth - 1) for k in range(rng.randrange(4))}

    for _ in range(300):
        document = {"k\"ey": [value(3) for _ in range(rng.randrange(4))], "o": {"i": value(2)}, "l": [value(1)]} if rng.random() < 0.7 else [value(3) for _ in range(3)]
        data = json.dumps(document, indent=rng.choice([None, 1])).encode()
        assert cut(data, rng.randrange(1, 30)) == (plain(document), None)


def test_broken_files():
    for data, error in ((b'{"a": [1', "open"), (b'{"a": "x}', "string"), (b'{"a": 1}]', "closes nothing"), (b'{"a": [1}', "closes"), (b"", "no object or list"), (b"null", "no object")):
        for step in (1, 3, 50):
            assert error in cut(data, step)[1]


def same(a, b):
    key = lambda r: json.dumps(r, sort_keys=True, default=str)
    return sorted((r.asDict(recursive=True) for r in a), key=key) == sorted((r.asDict(recursive=True) for r in b), key=key)


@pytest.fixture
def crawls(tmp_path):
    result = {"manifest": {"sample_id": "s1", "question": "COMPARE  tools"}, "answer": {"text": 'Zeno "x" {,]'}}
    planned = CRAWL | {"plan": [{"sample_id": "q04-r09", "question_id": "q04"}], "run": {"id": "x", "samples": [1]}}
    return {"r1": planned, "r2": [result, "junk", result], "r3": {"results": [result, result], "note": "n"}, "r4": result, "r5": {"samples": [], "results": [result]}}


def test_read_crawls(spark, tmp_path, crawls):
    for name, document in crawls.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(document, indent=1, ensure_ascii=False))
    (tmp_path / "r6.json").write_text('{"samples": [{"sample_id": "q01-r01"}, {"sample_id": ')
    asked = questions(spark).drop("run_id").crossJoin(spark.createDataFrame([(n,) for n in crawls], "run_id string"))
    strings = spark.createDataFrame([(n, json.dumps(d)) for n, d in crawls.items()], "run_id string, body string")
    want = ingest.import_crawl(strings, asked).drop("references").collect()
    for step in (37, 1 << 20):
        got, errors = files.read_crawls(spark, str(tmp_path), step)
        found = ingest.import_crawl(got, asked).drop("references").where("run_id < 'r6'").collect()
        assert same(found, want)
        assert sorted(r["path"][-7:-5] for r in errors.collect()) == ["r6"]
        assert got.where("run_id = 'r6'").count() == 1


def test_read_banks(spark, tmp_path):
    broken = valid()
    broken["questions"][1]["user_question"] = "Buy it, MirthFox"
    broken["questions"].append("junk")
    shapeless = valid() | {"questions": {"a": 1}}
    docs = [valid(), broken, shapeless]
    for k, document in enumerate(docs):
        (tmp_path / f"b{k}.json").write_text(json.dumps(document, indent=2))
    want = bank.findings(load(spark, *docs)).collect()
    loaded, errors = files.read_banks(spark, f"{tmp_path}/*.json", 501)
    assert same(bank.findings(loaded).collect(), want) and errors.count() == 0
    asked = ingest.import_questions(files.read_questions(spark, f"{tmp_path}/b0.json", 333)[0])
    assert same(asked.drop("run_id").collect(), ingest.import_questions(raw(spark, valid())).drop("run_id").collect())


def odd_banks():
    """Banks in odd spellings, among them a broken file and a root list, as (name, text)."""
    more = valid() | {"note": 'a "b" \\ [', "other": [1, {"x": "]"}], "plain": {"k": {"z": []}}}
    more["questions"] = [*more["questions"], "junk", None, {"user_question": "Buy it, \\\"MirthFox\\\"é🙂", "x": ["}", "\\"]}, []]
    texts = [json.dumps(valid()), json.dumps(more, indent=2, ensure_ascii=False), json.dumps({"questions": {"a": 1}}), json.dumps([valid()]), "{}", '{"questions": []}', '{"questions": [{"a": 1}, {"b"']
    return [(f"b{k}.json", text) for k, text in enumerate(texts)]


def test_small_files_are_read_whole(spark):
    """Small files that are read whole, and some of them by ranges, give the same banks."""
    written = files.write_files(spark.createDataFrame(odd_banks(), "name string, body string"))
    sizes = sorted(r["length"] for r in written.collect())
    assert sizes == sorted(len(text.encode()) for _, text in odd_banks())
    found = []
    for step in (files.RANGE_BYTES, 30):
        read, errors = files.read_banks(spark, written, step)
        tables = [read.config.select("bank_id", "questions", F.col("doc").cast("string")), read.rows.select("bank_id", "row_no", F.to_json("q"), F.to_json("fields"))]
        tables += [read.shapeless, errors.select(F.substring_index("path", "/", -1), "error")]
        found.append([sorted(str(tuple(r)) for r in t.collect()) for t in tables])
    assert sizes[0] < 30 < sizes[-1] and found[0] == found[1]
    # What could be cut out of the broken file is a bank too.
    assert [len(rows) for rows in found[0]] == [4, 2 * len(valid()["questions"]) + 5, 3, 1]


def test_many_small_files(spark):
    """No question of a small file is joined or shuffled, nothing that grows with the banks is broadcast, and banks are written to files by all cores."""
    written = files.write_files(spark.createDataFrame(odd_banks(), "name string, body string"))
    rows = files.read_banks(spark, written)[0].rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    query = registry.QUERIES["file_bank_rivals"](spark, "/root/testdata/sf0.001")
    assert "Join" not in query._jdf.queryExecution().optimizedPlan().toString()
    lists = banks._documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert lists.count("RepartitionByExpression") == 1


def test_nested_values_in_few_steps(monkeypatch):
    """What lies within an element is passed over from bracket to bracket, not from string to string; a file that breaks off there is read once."""
    searches = []

    class Counted:
        def search(self, *args):
            searches.append(1)
            return token.search(*args)

    token = files.TOKEN
    monkeypatch.setattr(files, "TOKEN", Counted())
    row = {f"k{k}": "a,b" for k in range(500)}
    document = {"config": row, "questions": [row] * 3}
    assert cut(json.dumps(document).encode(), 1 << 20) == (plain(document), None)
    assert len(searches) < 40
    text = json.dumps(document)
    assert "open" in cut(text[: text.rindex('"k400"')].encode(), 1 << 20)[1]
