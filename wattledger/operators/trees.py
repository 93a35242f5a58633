"""Documents as lists of nodes, and back: JSON or variants of any depth unfolded, changed and written again by column expressions.

A node has its ``places`` (the position in each parent from the root on), its ``names`` (the field's name, null for an entry of a
list), its ``kind`` (OBJECT, ARRAY, STRING, BIGINT, DOUBLE, DECIMAL, BOOLEAN, VOID, TIMESTAMP, TIMESTAMP_NTZ, DATE, BINARY, ..) and, but
for objects and lists, its ``text`` as JSON. A document's nodes are one array in its row, in document order, so nothing is
shuffled: a level's children are made from the level before, as many times as the deepest document asks for, which one pass
over the brackets tells. ``written`` joins the nodes again: what a node has to write before and after itself follows from
the node before and the node after it.

Names are kept apart, so a name with dots is one name; ``path_text`` shows it in brackets and quotes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.scratch import keep

LEVELS = 12  # unfolded in one plan; deeper documents are written in between
NODE = "struct<places:array<int>,names:array<string>,kind:string,text:string>"
_OPEN = "struct<places:array<int>,names:array<string>,kind:string,text:string,v:variant>"


# all repetitions are possessive: they run in loops, so texts of any length pass
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_SKIP = rf'\G((?:[^"{{stop}}]++|{_STRING})*+)'


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def depth(json: Column) -> Column:
    """How many objects and lists lie inside each other in a JSON text."""
    brackets = F.regexp_replace(F.regexp_replace(json, _STRING, ""), r"[^\[\]{}]++", "")
    state = lambda now, most: F.struct(now.cast("int").alias("now"), most.cast("int").alias("most"))
    step = lambda a, b: let(a["now"] + F.when(b.isin("{", "["), 1).otherwise(-1), lambda n: state(n, F.greatest(n, a["most"])))
    return F.aggregate(F.split(brackets, ""), state(F.lit(0), F.lit(0)), lambda a, b: F.when(b == "", a).otherwise(step(a, b)), lambda a: a["most"])


def kind_of(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z_]+", 0)


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def _nested(kind: Column) -> Column:
    return kind.isin("OBJECT", "ARRAY")


def _scalar(v: Column, kind: Column) -> Column:
    return F.when(~_nested(kind), F.to_json(v))


def _variant_children(x: Column) -> Column:
    child = lambda v, i, name: let(kind_of(v), lambda kind: F.struct(F.concat(x["places"], F.array(i)).alias("places"), F.concat(x["names"], F.array(name)).alias("names"), kind.alias("kind"), _scalar(v, kind).alias("text"), F.when(_nested(kind), v).alias("v")))
    fields = F.transform(F.map_entries(F.try_variant_get(x["v"], "$", "map<string,variant>")), lambda e, i: child(e["value"], i, e["key"]))
    items = F.transform(F.try_variant_get(x["v"], "$", "array<variant>"), lambda v, i: child(v, i, F.lit(None).cast("string")))
    return F.when(x["kind"] == "OBJECT", fields).otherwise(items).cast(f"array<{_OPEN}>")


_MARK = "\ue000"


def _marked(json: Column) -> Column:
    """The same JSON with each number as a string behind a mark, as parsers keep texts as they are but not numbers; strings that begin with the mark get one more."""
    doubled = F.regexp_replace(json, rf'(?<!\\)"(?={_MARK}|\\u[eE]000)', f'"{_MARK}')
    return F.regexp_replace(doubled, _SKIP.format(stop=r"\-\d") + r"(-?\d[\d.eE+\-]*+)", f'$1"{_MARK}$2"')


def skeleton(json: Column) -> Column:
    """A valid JSON text with its names and the kinds of its values in place of the values: ``"s"``, 0, 0.5, true and null.

    Only numbers whose form tells their kind are replaced: whole ones of up to 18 digits, decimals of up to 15 and 15.
    """
    number, whole, decimal = r"-?\d[\d.eE+\-]*+", r"-?\d{1,18}(?![\d.eE])", r"-?\d{1,15}\.\d{1,15}(?![\deE])"
    one = lambda text, form, shown: F.regexp_replace(text, rf'\G((?:[^"\-\d]++|{_STRING}|(?!{form}){number})*+){form}', f"$1{shown}")
    texts = F.regexp_replace(json, rf'\G((?:[^"]++|{_STRING}\s*+:)*+){_STRING}', '$1"s"')
    truths = F.regexp_replace(texts, _SKIP.format(stop="f") + "false", "$1true")
    return one(one(truths, whole, "0"), decimal, "0.5")


def _unmarked(text: Column) -> Column:
    """A string's text as JSON: without its mark a string again, or the number that it stands for."""
    bare = F.substr(text, F.lit(2))
    return F.when(text.startswith(_MARK), F.when(bare.startswith(_MARK), quoted(bare)).otherwise(bare)).otherwise(quoted(text))


def _text_children(x: Column) -> Column:
    """Children with the text that stands there: numbers as they are written, fields in their order."""

    def child(raw: Column, v: Column, i: Column, name: Column) -> Column:
        number = raw.startswith(_MARK) & ~raw.startswith(_MARK * 2)
        kind_and_text = lambda kind: F.struct(F.when((kind == "STRING") & number, F.when(raw.rlike("[.eE]"), "DOUBLE").otherwise("BIGINT")).otherwise(kind).alias("k"), F.when(kind == "STRING", _unmarked(raw)).when(kind == "VOID", "null").otherwise(raw).alias("t"))
        plain = F.when(name.startswith(_MARK), F.substr(name, F.lit(2))).otherwise(name)
        return let(kind_and_text(kind_of(v)), lambda kt: F.struct(F.concat(x["places"], F.array(i)).alias("places"), F.concat(x["names"], F.array(plain)).alias("names"), kt["k"].alias("kind"), kt["t"].alias("text"), F.lit(None).cast("variant").alias("v")))

    v = F.parse_json(x["text"])
    fields = let(F.try_variant_get(v, "$", "map<string,variant>"), lambda known: F.transform(F.map_entries(F.from_json(x["text"], "map<string,string>")), lambda e, i: child(e["value"], F.element_at(known, e["key"]), i, e["key"])))
    items = let(F.try_variant_get(v, "$", "array<variant>"), lambda known: F.transform(F.from_json(x["text"], "array<string>"), lambda raw, i: child(raw, F.get(known, i), i, F.lit(None).cast("string"))))
    return F.when(x["kind"] == "OBJECT", fields).otherwise(items).cast(f"array<{_OPEN}>")


def unfold(df: DataFrame, document: str, name: str = "_nodes", as_written: bool = False, levels: int | None = None) -> DataFrame:
    """``df`` with the nodes of each document; null where the text is no JSON.

    ``document`` is a JSON text or a variant; ``as_written`` keeps the text of numbers, for JSON texts. ``levels`` spares the
    look for the deepest document where the caller knows a bound.
    """
    is_variant = dict(df.dtypes)[document] == "variant"
    text = F.to_json(document) if is_variant else F.col(document)
    if levels is None:
        levels = df.agg(F.max(depth(text))).first()[0] or 0
    parsed = F.col(document) if is_variant else F.try_parse_json(document)
    as_text = as_written and not is_variant
    whole = lambda v, kind: F.when(_nested(kind), _marked(F.col(document))).when(kind.isin("BIGINT", "DECIMAL", "DOUBLE"), F.trim(document)).otherwise(F.to_json(v)) if as_text else _scalar(v, kind)
    root = let(parsed, lambda v: let(kind_of(v), lambda kind: F.struct(F.array().cast("array<int>").alias("places"), F.array().cast("array<string>").alias("names"), kind.alias("kind"), whole(v, kind).alias("text"), v.alias("v"))))
    done, front = f"{name}_done", f"{name}_front"
    out = df.withColumn(front, F.when(parsed.isNotNull(), F.array(root.cast(_OPEN)))).withColumn(done, F.array().cast(f"array<{NODE}>"))
    closed = lambda x: F.struct(x["places"].alias("places"), x["names"].alias("names"), x["kind"].alias("kind"), F.when(~_nested(x["kind"]), x["text"]).alias("text"))
    children = _text_children if as_text else _variant_children
    for level in range(levels + 1):
        out = out.withColumn(done, F.concat(done, F.transform(front, closed)))
        if level < levels:
            out = out.withColumn(front, F.flatten(F.transform(F.filter(front, lambda x: _nested(x["kind"])), children)))
            if level % LEVELS == LEVELS - 1:
                out = keep(out, "levels")
    # arrays of structs sort by their first field, which is the order of the document
    return out.withColumn(name, F.array_sort(done)).drop(done, front)


def written(nodes: Column) -> Column:
    """The JSON text of a document's nodes in order, without white space."""
    empty_places, none = F.array().cast("array<int>"), F.lit("")
    closing = lambda x, below: F.array_join(F.transform(F.filter(F.reverse(F.sequence(F.lit(0), F.size(x["names"]))), lambda j: (j >= below) & (j < F.size(x["names"]))), lambda j: F.when(F.get(x["names"], j).isNull(), "]").otherwise("}")), "")

    def token(all_: Column, x: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.size(F.coalesce(F.get(all_, i - 1)["places"], empty_places)))
        after = F.size(F.coalesce(F.get(all_, i + 1)["places"], empty_places))
        own = F.size(x["places"])
        last = i == F.size(all_) - 1
        leaf = last | (after <= own)
        comma = F.when((own > 0) & (before >= own), ",").otherwise(none)
        label = let(F.get(x["names"], own - 1), lambda n: F.when(n.isNotNull(), F.concat(quoted(n), F.lit(":"))).otherwise(none))
        opened = F.when(x["kind"] == "OBJECT", "{").when(x["kind"] == "ARRAY", "[").otherwise(x["text"])
        shut = F.when(leaf & (x["kind"] == "OBJECT"), "}").when(leaf & (x["kind"] == "ARRAY"), "]").otherwise(none)
        # the parents that end here, from the inmost to the one beside which the next node stands
        ends = F.when(leaf, closing(x, F.when(last, F.lit(0)).otherwise(after))).otherwise(none)
        return F.concat(comma, F.when(own > 0, label).otherwise(none), opened, shut, ends)

    return let(nodes, lambda all_: F.when(F.size(all_) > 0, F.array_join(F.transform(all_, lambda x, i: token(all_, x, i)), "")))


def path_text(names: Column) -> Column:
    """Names joined by dots, ``[]`` for entries of lists; a name with dots, brackets or quotes as ``['name']``."""
    plain = lambda n: F.when(n.isNull(), "[]").when(n.rlike(r"[.\[\]']") | (n == ""), F.concat(F.lit("['"), F.replace(n, F.lit("'"), F.lit("\\'")), F.lit("']"))).otherwise(F.concat(F.lit("."), n))
    return F.ltrim(F.array_join(F.transform(names, plain), ""), F.lit("."))


def plain_text(x: Column) -> Column:
    """The text of a scalar node outside JSON; null for null, objects and lists."""
    inner = F.substr(x["text"], F.lit(2), F.length(x["text"]) - 2)
    return F.when(_nested(x["kind"]) | (x["kind"] == "VOID"), None).when(~x["text"].startswith('"'), x["text"]).when(x["text"].contains("\\"), F.try_variant_get(F.parse_json(x["text"]), "$", "string")).otherwise(inner)


def without(nodes: Column, names: Column) -> Column:
    """The nodes that neither have one of the names nor lie below one that has."""
    return F.filter(nodes, lambda x: ~F.coalesce(F.arrays_overlap(F.filter(x["names"], lambda n: n.isNotNull()), names), F.lit(False)))


# fixed values: the tags of typed export
TAG, REFERENCE = "__type", "__reference"
TAGS = {"DOUBLE": "double", "FLOAT": "float", "DECIMAL": "decimal", "DATE": "date", "TIMESTAMP": "timestamp", "TIMESTAMP_NTZ": "datetime", "BINARY": "bytes"}
_LIKE_TAG = "^__+type$"


def typed(nodes: Column) -> Column:
    """The nodes of a variant, with tags where JSON has no type: ``{"__type": .., "value": ..}``.

    Whole numbers, texts, truth values and null stay as they are; bytes are base64. An object with the one field
    ``__reference`` becomes ``{"path": .., "__type": "reference"}``. Fields called ``__type`` get one more underscore.
    """
    tags = F.create_map(*(F.lit(x) for pair in TAGS.items() for x in pair))
    in_string = lambda text: F.when(text.startswith('"'), text).otherwise(quoted(text))
    last = lambda names: F.get(names, F.size(names) - 1)
    escaped = lambda names: F.transform(names, lambda n: F.when(n.rlike(_LIKE_TAG), F.concat(F.lit("_"), n)).when(n == REFERENCE, "path").otherwise(n))

    def one(x: Column) -> Column:
        text = F.when(F.map_contains_key(tags, x["kind"]), F.concat(F.lit(f'{{"{TAG}":"'), F.try_element_at(tags, x["kind"]), F.lit('","value":'), in_string(x["text"]), F.lit("}"))).otherwise(x["text"])
        text = F.when(F.coalesce(last(x["names"]) == REFERENCE, F.lit(False)), F.concat(x["text"], F.lit(f',"{TAG}":"reference"'))).otherwise(text)
        return F.struct(x["places"].alias("places"), escaped(x["names"]).alias("names"), x["kind"].alias("kind"), text.alias("text"))

    return F.transform(nodes, one)


def _untagged(fields: Column) -> Column:
    """The variant that an object's fields stand for."""
    tag, value = (F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", "string") for name in (TAG, "value"))
    plain = F.to_variant_object(F.map_from_entries(F.transform(F.map_entries(fields), lambda e: F.struct(F.when(e["key"].rlike("^___+type$"), F.substr(e["key"], F.lit(2))).otherwise(e["key"]).alias("key"), e["value"].alias("value")))))
    out = F.when(tag.isNull(), plain)
    for name, kind in {"double": "double", "float": "float", "date": "date", "timestamp": "timestamp", "datetime": "timestamp_ntz"}.items():
        out = out.when(tag == name, value.cast(kind).cast("variant"))
    decimal = F.when(value.contains("."), F.parse_json(value)).otherwise(value.cast("decimal(38,0)").cast("variant"))
    out = out.when(tag == "decimal", decimal).when(tag == "bytes", F.unbase64(value).cast("variant"))
    out = out.when(tag == "reference", F.to_variant_object(F.create_map(F.lit(REFERENCE), F.try_element_at(fields, F.lit("path")))))
    return out.otherwise(plain)


def from_typed(df: DataFrame, json: str, key: str) -> DataFrame:
    """(key, document): the variants that tagged JSON texts stand for; null where the text is no JSON.

    Objects and lists are put together from the deepest level up, each by one grouping of its children; a document's nodes meet
    by key and parent, so that no task holds more than one object's fields.
    """
    nodes = unfold(df.select(key, json), json, "nodes")
    rows = keep(nodes.select(key, F.explode("nodes").alias("x")).select(key, "x.*", F.size("x.places").alias("depth"), F.when(~_nested(F.col("x.kind")), F.parse_json("x.text")).alias("v")).drop("text"), "typed-nodes")
    deepest = rows.agg(F.max("depth")).first()[0] or 0
    level = rows.where(F.col("depth") == deepest)
    for d in range(deepest, 0, -1):
        child = F.struct(F.element_at("places", -1).alias("place"), F.element_at("names", -1).alias("name"), F.col("v").alias("v"))
        parts = level.select(key, F.slice("places", 1, d - 1).alias("at"), child.alias("child")).groupBy(key, "at").agg(F.array_sort(F.collect_list("child"), lambda a, b: a["place"] - b["place"]).alias("children"))
        above = rows.where(F.col("depth") == d - 1).withColumn("at", F.col("places")).join(parts, [key, "at"], "left")
        children = F.col("children")
        fields = F.map_from_entries(F.transform(children, lambda c: F.struct(c["name"].alias("key"), c["v"].alias("value"))))
        made = (
            F.when((F.col("kind") == "OBJECT") & children.isNotNull(), _untagged(fields)).when((F.col("kind") == "ARRAY") & children.isNotNull(), F.to_variant_object(F.transform(children, lambda c: c["v"])))
            .when(F.col("kind") == "OBJECT", F.parse_json(F.lit("{}"))).when(F.col("kind") == "ARRAY", F.parse_json(F.lit("[]"))).otherwise(F.col("v"))
        )
        level = above.withColumn("v", made).select(*rows.columns)
        if d % LEVELS == 1 and d > 1:
            level = keep(level, "typed-levels")
    if not deepest:
        empty = F.when(F.col("kind") == "OBJECT", F.parse_json(F.lit("{}"))).when(F.col("kind") == "ARRAY", F.parse_json(F.lit("[]"))).otherwise(F.col("v"))
        level = level.withColumn("v", empty)
    return df.select(key).join(level.select(key, F.col("v").alias("document")), key, "left")
