"""Report grounding: statements, references and numbers against facts.

Facts are flattened payload sections: (run_id, section, pointer, kind, value, size). Statements are
(run_id, module_id, path, idx, field, text), references (run_id, module_id, pointer, ref).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import fact_tokens, has_free_number, number_tokens, or_empty, strip


def _inside(node: Column) -> Column:
    """The (pointer, v) nodes directly under `node`; none under a scalar."""
    items = F.try_variant_get(node["v"], "$", "array<variant>")
    members = F.transform(
        F.map_entries(F.try_variant_get(node["v"], "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))
    )
    listed = F.transform(items, lambda x, k: F.struct(k.cast("string").alias("k"), x.alias("v")))

    def placed(e: Column) -> Column:
        spelt = F.replace(F.replace(e["k"], F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
        return F.struct(F.concat(node["pointer"], F.lit("/"), spelt).alias("pointer"), e["v"].alias("v"))

    return F.transform(F.coalesce(members, listed), placed)


def flatten(sections: DataFrame) -> DataFrame:
    """Every node of each section: pointer, kind (OBJECT, ARRAY or a scalar's type), value text, size of lists.

    Each body is taken apart level by level inside its own row. There are no more levels than brackets that
    open in its text, so that many turns reach the end of any nesting; turns after the last level do nothing.
    """
    none = F.array().cast("array<struct<pointer:string,v:variant>>")
    root = F.array(F.struct(F.lit("").alias("pointer"), F.col("body").alias("v")))
    text = F.coalesce(F.to_json("body"), F.lit(""))
    opened = F.length(text) - F.length(F.translate(text, "[{", ""))
    start = F.struct(none.alias("done"), root.alias("level"))

    def turn(at: Column, _: Column) -> Column:
        inner = F.flatten(F.filter(F.transform(at["level"], _inside), lambda x: x.isNotNull()))
        return F.when(F.size(at["level"]) == 0, at).otherwise(F.struct(F.concat(at["done"], at["level"]).alias("done"), inner.alias("level")))

    nodes = F.aggregate(F.sequence(F.lit(0), opened), start, turn, lambda at: at["done"])
    node = sections.select("run_id", "section", F.explode(nodes).alias("e")).select("run_id", "section", "e.*")
    node = node.withColumn("kind", F.regexp_extract(F.schema_of_variant("v"), "^[A-Z]+", 0))
    items = F.try_variant_get(F.col("v"), "$", "array<variant>")
    return node.select(
        "run_id", "section", "pointer", "kind", F.when(~F.col("kind").isin("OBJECT", "ARRAY"), F.try_variant_get(F.col("v"), "$", "string")).alias("value"),
        F.when(F.col("kind") == "ARRAY", F.size(items)).alias("size")
    )


def dotted(pointer: Column) -> Column:
    """A JSON pointer as a dotted path."""
    return F.replace(F.replace(F.replace(F.regexp_replace(pointer, "^/", ""), F.lit("/"), F.lit(".")), F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~"))


def _short(number: Column) -> Column:
    """A double with six significant digits, as C's %g spells it."""
    digits = F.format_string("%.5e", number)
    exponent = F.regexp_extract(digits, r"e([+-]\d+)$", 1).cast("int")

    def trimmed(c: Column) -> Column:
        return F.when(F.contains(c, F.lit(".")), F.regexp_replace(c, r"\.?0+$", "")).otherwise(c)

    wide = F.concat(
        trimmed(F.regexp_extract(digits, "^(.*)e", 1)), F.lit("e"), F.when(exponent < 0, "-").otherwise("+"), F.lpad(F.abs(exponent).cast("string"), 2, "0")
    )
    return F.when(number == 0, "0").when((exponent < -4) | (exponent >= 6), wide).otherwise(trimmed(digits.cast("decimal(38,12)").cast("string")))


def allowed_numbers(facts: DataFrame) -> DataFrame:
    """(run_id, token): spellings of the numbers that facts hold.

    Numbers in [-1, 1] also count as percentages, texts give the numbers written in them, lists their
    length; booleans are no numbers.
    """
    numeric = F.col("kind").isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
    x = F.col("value").try_cast("double")
    scaled = _short(x * 100)
    own = F.when(numeric, F.when(F.abs(x) <= 1, F.array(_short(x), scaled, F.concat(scaled, F.lit("%")))).otherwise(F.array(_short(x))))
    written = F.when(F.col("kind") == "STRING", F.flatten(F.transform(number_tokens(F.col("value")), lambda t: F.array(t, F.regexp_replace(t, "%$", "")))))
    length = F.when(F.col("kind") == "ARRAY", F.array(F.col("size").cast("string")))
    return facts.select("run_id", F.explode(F.coalesce(own, written, length)).alias("token")).where("token is not null").distinct()


def ungrounded_numbers(statements: DataFrame, allowed: DataFrame) -> DataFrame:
    """(run_id, module_id, path, idx, token): numbers in statements that no fact holds, with or without `%`."""
    each = statements.select("run_id", "module_id", "path", "idx", F.explode(number_tokens(or_empty(F.col("text")))).alias("token"))
    held = allowed.select("run_id", F.col("token").alias("held"))
    plain = each.withColumn("bare", F.regexp_replace("token", "%$", ""))
    left = plain.join(held.withColumnRenamed("held", "token"), ["run_id", "token"], "left_anti")
    return left.join(held.withColumnRenamed("held", "bare"), ["run_id", "bare"], "left_anti").select("run_id", "module_id", "path", "idx", "token")


def limits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(fixed.TEXT_LIMITS), "module_id string, path string, field string, max_length int, may_be_empty boolean, fewest int, most int"
    )


def text_findings(statements: DataFrame) -> DataFrame:
    """(run_id, module_id, path, idx, field, code): empty, too long, banned, advising, or unknown texts."""
    rules = F.broadcast(limits(statements.sparkSession))
    rows = statements.join(rules, ["module_id", "path", "field"], "left")
    text = or_empty(F.col("text"))
    codes = F.array(
        F.when(F.col("max_length").isNull(), "UNKNOWN_FIELD"), F.when(~F.col("may_be_empty") & (strip(text) == ""), "EMPTY"),
        F.when(F.length(text) > F.col("max_length"), "TOO_LONG"),
        F.when(F.contains(text, F.lit("```")) | text.rlike(fixed.BANNED), "BANNED"), F.when(
            (F.col("module_id") == "M05") & text.rlike(fixed.ACTION_WORDS), "ADVICE"
        ),
    )
    return rows.select("run_id", "module_id", "path", "idx", "field", F.explode(F.filter(codes, lambda x: x.isNotNull())).alias("code"))


def shape_findings(statements: DataFrame) -> DataFrame:
    """(run_id, module_id, path, field, n, code): lists with too few or too many entries in modules that are there."""
    rules = limits(statements.sparkSession)
    present = statements.select("run_id", "module_id").distinct()
    counts = statements.groupBy("run_id", "module_id", "path", "field").agg(F.count("*").alias("n"))
    rows = present.join(F.broadcast(rules), "module_id").join(counts, ["run_id", "module_id", "path", "field"], "left").fillna(0, ["n"])
    code = F.when(F.col("n") < F.col("fewest"), "TOO_FEW").when(F.col("n") > F.col("most"), "TOO_MANY")
    return rows.withColumn("code", code).where("code is not null").select("run_id", "module_id", "path", "field", "n", "code")


def parity_findings(statements: DataFrame, facts: DataFrame) -> DataFrame:
    """(run_id, path): category-action groups that have facts and no text, or text and no facts."""
    groups = facts.where("section = 'category_actions' and kind = 'ARRAY'").select(
        "run_id", F.regexp_replace("pointer", "^/", "").alias("path"), (F.col("size") > 0).alias("has_facts")
    )
    texts = statements.where("module_id = 'M05'").select("run_id", "path", (strip(or_empty(F.col("text"))) != "").alias("has_text"))
    return texts.join(groups, ["run_id", "path"], "left").where(F.coalesce("has_facts", F.lit(False)) != F.col("has_text")).select("run_id", "path")


def pointer_of(rows: DataFrame) -> Column:
    """The statement's pointer inside its module."""
    return F.concat_ws("/", F.lit(""), "path", F.col("idx").cast("string"), F.when(F.col("field") != "text", F.col("field")))


def pointer_findings(statements: DataFrame, refs: DataFrame) -> DataFrame:
    """(run_id, module_id, pointer, code): statements without references, references to no statement.

    Empty category groups and an empty summary need none.
    """
    asked = statements.where(
        ~(F.col("module_id").isin("M05") | ((F.col("module_id") == "M06") & (F.col("path") == "summary"))) | (strip(or_empty(F.col("text"))) != "")
    ).where("not (module_id = 'M06' and path = 'actions' and field = 'source_module')")
    asked = asked.withColumn("pointer", pointer_of(asked)).select("run_id", "module_id", "pointer").distinct()
    given = refs.select("run_id", "module_id", "pointer").distinct()
    return asked.join(given, ["run_id", "module_id", "pointer"], "left_anti").withColumn("code", F.lit("NO_REFERENCE")).unionByName(
        given.join(asked, ["run_id", "module_id", "pointer"], "left_anti").withColumn("code", F.lit("NO_STATEMENT"))
    )


def unresolved_references(refs: DataFrame, facts: DataFrame, statements: DataFrame, evidence: DataFrame, directions: DataFrame) -> DataFrame:
    """(run_id, module_id, pointer, ref) of references to nothing: `fact:`, `module:`, `evidence:` or `action:`."""
    each = refs.withColumn("kind", F.substring_index("ref", ":", 1)).withColumn("name", F.regexp_replace("ref", "^[^:]*:", ""))
    fact = facts.select("run_id", F.concat("section", "pointer").alias("name")).unionByName(
        facts.where("pointer = ''").select("run_id", F.concat("section", F.lit("/")).alias("name"))
    )
    module = statements.select(
        "run_id", F.concat("module_id", pointer_of(statements)).alias("name")
    ).unionByName(statements.select("run_id", F.col("module_id").alias("name")))
    known = (
        fact.withColumn("kind", F.lit("fact")).unionByName(module.withColumn("kind", F.lit("module")))
        .unionByName(evidence.select("run_id", F.col("evidence_id").alias("name")).withColumn("kind", F.lit("evidence")))
        .unionByName(directions.select("run_id", F.col("direction_id").alias("name")).withColumn("kind", F.lit("action")))
    )
    return each.join(known, ["run_id", "kind", "name"], "left_anti").select("run_id", "module_id", "pointer", "ref")


def claim_findings(claims: DataFrame, facts: DataFrame) -> DataFrame:
    """(run_id, claim_id, code): tokens that differ from the references as sets, tokens of no fact, bare numbers.

    `claims(run_id, claim_id, text, refs array<string>)`; references and tokens are dotted paths.
    """
    tokens = F.array_sort(F.array_distinct(fact_tokens(or_empty(F.col("text")))))
    rows = claims.withColumn("tokens", tokens)
    differ = rows.where(F.col("tokens") != F.array_sort(F.array_distinct("refs"))).select("run_id", "claim_id", F.lit("REFERENCES_DIFFER").alias("code"))
    bare = rows.where(has_free_number(or_empty(F.col("text")))).select("run_id", "claim_id", F.lit("BARE_NUMBER").alias("code"))
    paths = facts.select("run_id", F.concat_ws(".", "section", F.nullif(dotted(F.col("pointer")), F.lit(""))).alias("token"))
    lost = rows.select("run_id", "claim_id", F.explode("tokens").alias("token")).join(paths, ["run_id", "token"], "left_anti").select("run_id", "claim_id", F.lit("UNKNOWN_FACT").alias("code"))
    return differ.unionByName(bare).unionByName(lost.distinct())


def action_findings(actions: DataFrame, directions: DataFrame) -> DataFrame:
    """(run_id, direction_id, code): actions and directions that do not match one to one, or name another module."""
    told = actions.groupBy("run_id", "direction_id").agg(F.count("*").alias("told"), F.min("source_module").alias("told_module"))
    given = directions.groupBy("run_id", "direction_id").agg(F.count("*").alias("given"), F.min("source_module").alias("given_module"))
    both = told.join(given, ["run_id", "direction_id"], "full_outer").fillna(0, ["told", "given"])
    code = F.when(F.col("told") != 1, "ACTIONS").when(F.col("given") != 1, "DIRECTIONS").when(F.col("told_module") != F.col("given_module"), "SOURCE_MODULE")
    return both.withColumn("code", code).where("code is not null").select("run_id", "direction_id", "code")


DIRECTION_FIELDS = ("direction", "state", "posture", "key_evidence", "action_template")


def direction_findings(directions: DataFrame) -> DataFrame:
    """(run_id, direction_id, code): blank fields, and runs with more than three directions."""
    blank = F.array_join(F.filter(F.array(*[F.when(strip(or_empty(F.col(f))) == "", F.lit(f)) for f in DIRECTION_FIELDS]), lambda x: x.isNotNull()), ",")
    empty = directions.withColumn("blank", blank).where("blank != ''").select("run_id", "direction_id", F.concat(F.lit("BLANK:"), "blank").alias("code"))
    many = directions.groupBy("run_id").agg(F.count("*").alias("n")).where("n > 3").select(
        "run_id", F.lit(None).cast("string").alias("direction_id"), F.lit("TOO_MANY").alias("code")
    )
    return empty.unionByName(many)


def upload_rows(statements: DataFrame) -> DataFrame:
    """(run_id, place, module, path, index, field, value): the upload table, by place.

    Overview conclusion, action summary and the final module are no part of it; empty groups keep their row.
    """
    order = statements.sparkSession.createDataFrame(
        [(*row[:8], k) for k, row in enumerate(fixed.UPLOAD_ORDER)],
        "block int, module_id string, path string, field string, module string, to_path string, to_field string, indexed boolean, in_block int"
    )
    rows = statements.join(F.broadcast(order), ["module_id", "path", "field"])
    place = F.struct("block", F.coalesce("idx", F.lit(0)).alias("idx"), "in_block")
    return rows.select(
        "run_id", place.alias("place"), "module", F.col("to_path").alias("path"),
        F.when(F.col("indexed"), F.col("idx").cast("string")).otherwise("").alias("index"), F.col("to_field").alias("field"),
        or_empty(F.col("text")).alias("value")
    )


def write_upload_csv(rows: DataFrame, path: str) -> None:
    """One CSV folder for each run, with a byte order mark before the header and CRLF line ends."""
    bom = "﻿"
    out = rows.repartition("run_id").sortWithinPartitions("run_id", "place").select(
        "run_id", F.col("module").alias(f"{bom}module"), "path", "index", "field", "value"
    )
    out.write.partitionBy("run_id").csv(path, header=True, lineSep="\r\n", escape='"', emptyValue="", nullValue="", encoding="UTF-8")
