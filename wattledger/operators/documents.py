"""Documents as JSON: values at nested paths, shape contracts, geometry, assessments with issue codes, and canonical forms of old ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattledger.functions import maps as M
from wattledger.functions import scalars as S
from wattledger.operators import trees
from wattledger.operators.profiling import paths
from wattledger.operators.validate import Rules, computed, reasons

# fixed values: the fields of a sales document, of a master document and of its metadata; names of geometry
SALES_FIELDS = ("master", "meterNo", "meterNoNormalized", "provider", "customerNo", "accountNo", "totalAmountC", "monthlyTotalsC", "lastPurchaseAtISO", "daysSinceLastPurchase")
MASTER_FIELDS = ("lmPcode", "meterNo", "meterType", "customerNo", "accountNo", "refs", "metadata")
METADATA_FIELDS = ("createdAt", "createdByUid", "createdByUser", "updatedAt", "updatedByUid", "updatedByUser")
VISIBILITIES = ("VISIBLE", "INVISIBLE")
GEOMETRY = ("geometry", "Geometry", "GeometryJson", "geometryJson", "coordinates", "polygon")
CANONICAL_ID = "^[A-Z0-9]+$"
MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"


def value_at(document: Column, path: str) -> Column:
    """The text of the scalar at a dotted path of a variant; null if it isn't there."""
    return F.try_variant_get(document, _steps(path), "string")


def kind_at(document: Column, path: str) -> Column:
    """STRING, BIGINT, DECIMAL, BOOLEAN, VOID, OBJECT or ARRAY; null where the path isn't there."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(document, _steps(path), "variant")), "^[A-Z]+", 0)


def _steps(path: str) -> str:
    return "$" + "".join(f"['{step}']" for step in path.split("."))


def _keys(document: Column, path: str = "") -> Column:
    """The sorted keys of the object at a path; none if there is no object."""
    whole = document if not path else F.try_variant_get(document, _steps(path), "variant")
    return F.coalesce(F.array_sort(F.json_object_keys(F.to_json(whole))), F.array().cast("array<string>"))


def forbidden_paths(df: DataFrame, document: str, key: str, names: Sequence[str] = GEOMETRY) -> DataFrame:
    """(key, path) of every field, at any depth, that has one of the names."""
    found = F.array_distinct(F.transform(F.filter("_nodes", lambda x: F.coalesce(F.get(x["names"], F.size(x["names"]) - 1).isin(*names), F.lit(False))), lambda x: trees.path_text(x["names"])))
    return trees.unfold(df.select(key, document), document).select(key, F.explode(found).alias("path"))


def without_keys(df: DataFrame, document: str, names: Sequence[str] = GEOMETRY) -> DataFrame:
    """The documents without the fields of these names, at any depth; numbers stay as they are written, and so does text that is no JSON."""
    nodes = trees.unfold(df.withColumn(document, F.col(document).cast("string")), document, as_written=True)
    kept = trees.written(trees.without(F.col("_nodes"), F.array(*map(F.lit, names))))
    return nodes.withColumn(document, F.when(F.col("_nodes").isNull(), F.col(document)).otherwise(kept)).select(*df.columns)


def nested_arrays(df: DataFrame, document: str, key: str) -> DataFrame:
    """(key, path) of arrays that hold arrays, which the store refuses."""
    return paths(df, document, key).where("path like '%[]' and type = 'ARRAY'").select(key, "path").distinct()


def apply_patch(fields: Column, patch: Column) -> Column:
    """A document's map of dotted paths after a patch: a patched path loses what was below it."""
    kept = F.map_filter(fields, lambda k, v: ~F.exists(F.map_keys(patch), lambda p: (k == p) | k.startswith(F.concat(p, F.lit(".")))))
    return F.map_concat(kept, patch)


def delete_paths(fields: Column, gone: Column) -> Column:
    """A document's map of dotted paths without the given ones and all below them."""
    return F.map_filter(fields, lambda k, v: ~F.exists(gone, lambda p: (k == p) | k.startswith(F.concat(p, F.lit(".")))))


def preserved_digest(document: Column, owned: Sequence[str]) -> Column:
    """SHA-256 of a document's map of dotted paths without the owned fields, so that one can tell that nothing else has changed."""
    rest = delete_paths(document, F.array(*map(F.lit, owned)))
    return F.sha2(F.to_json(F.array_sort(F.map_entries(rest))), 256)


def assess_sales(df: DataFrame, document: str, key: str) -> DataFrame:
    """The rows with ``issues``, sorted codes of what is wrong with each sales document."""
    v = F.col("_v")
    text = {c: value_at(v, c) for c in ("master.id", "master.visibility", "meterNo", "meterNoNormalized", "provider", "totalAmountC", "lastPurchaseAtISO", "daysSinceLastPurchase")}
    kinds = {c: kind_at(v, c) for c in (*text, "master", "customerNo", "accountNo", "monthlyTotalsC")}
    name = lambda c: c.replace(".", "_")
    amounts = F.try_variant_get(v, "$.monthlyTotalsC", "map<string,variant>")
    parsed = computed(df, _v=F.coalesce(F.try_parse_json(document), F.parse_json(F.lit("{}"))))
    told = computed(parsed, _root=_keys(v), _master_keys=_keys(v, "master"), _amounts=amounts, **{f"_{name(c)}": x for c, x in text.items()}, **{f"_k_{name(c)}": x for c, x in kinds.items()})
    t, k, id_ = (lambda c: F.col(f"_{name(c)}")), (lambda c: F.coalesce(F.col(f"_k_{name(c)}"), F.lit(""))), F.col(key).cast("string")
    month_kind = lambda x: F.schema_of_variant(x)
    entries = F.map_entries("_amounts")
    whole = F.filter(entries, lambda e: month_kind(e["value"]) == "BIGINT")
    number = lambda e: e["value"].cast("bigint")
    months = computed(
        told,
        _months=F.array_sort(F.coalesce(F.map_keys("_amounts"), F.array().cast("array<string>"))), _all_whole=F.size(whole) == F.size(entries), _sum=F.aggregate(whole, F.lit(0).cast("bigint"), lambda a, e: a + number(e)),
        _bad_months=F.transform(F.filter(entries, lambda e: ~e["key"].rlike(MONTH)), lambda e: e["key"]), _bad_values=F.transform(F.filter(entries, lambda e: month_kind(e["value"]) != "BIGINT"), lambda e: e["key"]),
        _negative=F.transform(F.filter(whole, lambda e: number(e) < 0), lambda e: e["key"]), _latest=F.array_max(F.transform(F.filter(whole, lambda e: (number(e) > 0) & e["key"].rlike(MONTH)), lambda e: e["key"])),
    )
    total = F.when(k("totalAmountC") == "BIGINT", t("totalAmountC").try_cast("bigint"))
    days = F.when(k("daysSinceLastPurchase") == "BIGINT", t("daysSinceLastPurchase").try_cast("bigint"))
    last = F.when(k("lastPurchaseAtISO") == "STRING", t("lastPurchaseAtISO"))
    instant = S.zoned_time(last)
    in_order = F.forall(F.sequence(F.lit(1), F.greatest(F.size("_months") - 1, F.lit(1))), lambda i: F.get("_months", i).isNull() | (F.get("_months", i) == S.next_month(F.get("_months", i - 1))))
    contiguous = F.when(F.size("_bad_months") > 0, F.lit(False)).otherwise(in_order)
    is_map = k("master") == "OBJECT"
    id_text = F.when(k("master.id") == "STRING", t("master.id"))
    normal = F.when(k("meterNoNormalized") == "STRING", t("meterNoNormalized"))
    strange = lambda c: F.when(~c.rlike(CANONICAL_ID), F.lit(True)).otherwise(F.lit(False))
    rules: Rules = [
        ("IDENTITY_DOCUMENT_ID_NOT_CANONICAL", strange(id_)), ("MASTER_NOT_MAP", ~is_map), ("MASTER_MISSING_ID", is_map & (k("master.id") == "")), ("MASTER_ID_NOT_STRING", is_map & ~k("master.id").isin("", "STRING")),
        ("MASTER_ID_NOT_CANONICAL", strange(id_text)), ("IDENTITY_DOCUMENT_ID_VS_MASTER_ID_MISMATCH", id_text != id_), ("MASTER_VISIBILITY_MISSING", is_map & (k("master.visibility") == "")),
        ("MASTER_VISIBILITY_NOT_STRING", is_map & ~k("master.visibility").isin("", "STRING")), ("METER_NO_NOT_STRING", k("meterNo") != "STRING"), ("METER_NO_BLANK", (k("meterNo") == "STRING") & (t("meterNo") == "")),
        ("METER_NO_NORMALIZED_NOT_STRING", k("meterNoNormalized") != "STRING"), ("METER_NO_NORMALIZED_NOT_CANONICAL", strange(normal)), ("IDENTITY_DOCUMENT_ID_VS_METER_NO_NORMALIZED_MISMATCH", normal != id_),
        ("IDENTITY_MASTER_ID_VS_METER_NO_NORMALIZED_MISMATCH", normal != id_text), ("IDENTITY_METER_NO_NORMALIZATION_MISMATCH", (k("meterNo") == "STRING") & (S.meter_no(t("meterNo")) != normal)),
        ("PROVIDER_NOT_STRING", k("provider") != "STRING"), ("CUSTOMER_NO_NOT_STRING", k("customerNo") != "STRING"), ("ACCOUNT_NO_NOT_STRING", k("accountNo") != "STRING"),
        ("TOTAL_AMOUNT_C_NOT_INTEGER", k("totalAmountC") != "BIGINT"), ("TOTAL_AMOUNT_C_NEGATIVE", total < 0), ("MONTHLY_TOTALS_C_NOT_MAP", k("monthlyTotalsC") != "OBJECT"), ("MONTHLY_TOTALS_C_EMPTY", (k("monthlyTotalsC") == "OBJECT") & (F.size("_months") == 0)),
        ("MONTH_RANGE_NOT_CONTIGUOUS", (F.size("_months") > 0) & ~contiguous), ("TOTAL_AMOUNT_C_DOES_NOT_EQUAL_MONTHLY_SUM", (k("monthlyTotalsC") == "OBJECT") & F.col("_all_whole") & (total != F.col("_sum"))),
        ("LAST_PURCHASE_AT_ISO_INVALID_TYPE", ~k("lastPurchaseAtISO").isin("STRING", "VOID")), ("DAYS_SINCE_LAST_PURCHASE_INVALID_TYPE", ~k("daysSinceLastPurchase").isin("BIGINT", "VOID")), ("DAYS_SINCE_LAST_PURCHASE_NEGATIVE", days < 0),
        ("POSITIVE_TOTAL_LAST_PURCHASE_MISSING", (total > 0) & (F.coalesce(last, F.lit("")) == "")), ("LAST_PURCHASE_AT_ISO_INVALID_OR_TIMEZONE_FREE", (total > 0) & (last != "") & instant.isNull()),
        ("POSITIVE_TOTAL_DAYS_SINCE_MISSING", (total > 0) & days.isNull()), ("ZERO_TOTAL_LAST_PURCHASE_NOT_NULL", (total == 0) & (k("lastPurchaseAtISO") != "VOID")), ("ZERO_TOTAL_DAYS_SINCE_NOT_NULL", (total == 0) & (k("daysSinceLastPurchase") != "VOID")),
    ]
    named = lambda code, which: F.transform(which, lambda x: F.concat(F.lit(f"{code}:"), x))
    listed = lambda names: F.array(*map(F.lit, names))
    one = lambda code, shown, hit: F.when(hit, F.array(F.concat(F.lit(f"{code}:"), shown))).otherwise(F.array().cast("array<string>"))
    every = [
        reasons(rules), named("ROOT_MISSING_FIELD", F.array_except(listed(SALES_FIELDS), "_root")), named("ROOT_UNEXPECTED_FIELD", F.array_except("_root", listed(SALES_FIELDS))), named("MASTER_UNEXPECTED_FIELD", F.array_except("_master_keys", listed(("id", "visibility")))),
        one("MASTER_VISIBILITY_INVALID_VALUE", t("master.visibility"), (k("master.visibility") == "STRING") & ~t("master.visibility").isin(*VISIBILITIES)), one("PROVIDER_NOT_CONLOG", t("provider"), (k("provider") == "STRING") & (t("provider") != "conlog")),
        named("MONTH_KEY_INVALID", F.coalesce("_bad_months", F.array().cast("array<string>"))), named("MONTH_VALUE_NOT_INTEGER", F.coalesce("_bad_values", F.array().cast("array<string>"))), named("MONTH_VALUE_NEGATIVE", F.coalesce("_negative", F.array().cast("array<string>"))),
        one("LAST_PURCHASE_MONTH_MISMATCH", F.concat(S.month_of(instant), F.lit("->"), "_latest"), F.coalesce((total > 0) & (S.month_of(instant) != F.col("_latest")), F.lit(False))),
    ]
    return months.select(*df.columns, F.array_sort(F.concat(*every)).alias("issues"))


def unfold_masters(df: DataFrame, document: str, key: str = "masterId") -> DataFrame:
    """(key, stored_code, and the fields of a master row): what is wrong with a stored document's shape, in the order of the rules, null if nothing is."""
    v = F.col("_v")
    fields = {"meterNoRaw": "meterNo.raw", "meterNoNormalized": "meterNo.normalized", "lmPcode": "lmPcode", "meterType": "meterType", "customerNo": "customerNo", "accountNo": "accountNo", "salesId": "refs.sales.id", "salesProvider": "refs.sales.provider"}
    contract = {"": MASTER_FIELDS, "meterNo": ("raw", "normalized"), "refs": ("asts", "sales"), "refs.asts": ("id",), "refs.sales": ("id", "provider"), "metadata": METADATA_FIELDS}
    texts = (*fields.values(), "metadata.createdByUid", "metadata.createdByUser", "metadata.updatedByUid", "metadata.updatedByUser")
    parsed = computed(df, _v=F.try_parse_json(document))
    told = computed(
        parsed, _root_kind=F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), **{f"_keys_{p.replace('.', '_')}": _keys(v, p) for p in contract}, **{f"_kind_{p.replace('.', '_')}": kind_at(v, p) for p in contract if p},
        _wrong=F.array_compact(F.array(*(F.when(~F.coalesce(kind_at(v, p) == "STRING", F.lit(False)), F.lit(p)) for p in texts))), _ast=kind_at(v, "refs.asts.id"),
        _times=F.array(*(S.zoned_time(value_at(v, f"metadata.{f}")) for f in ("createdAt", "updatedAt"))), _actors=F.array(*(F.trim(value_at(v, f"metadata.{f}")) for f in ("createdByUid", "createdByUser"))), **{f: value_at(v, p) for f, p in fields.items()},
    )
    id_ = F.col(key).cast("string")
    code = F.when(~id_.rlike(CANONICAL_ID) | (S.meter_no(id_) != id_), "MM_DOCUMENT_ID_NONCANONICAL").when(F.coalesce(F.col("_root_kind"), F.lit("")) != "OBJECT", "MM_DOCUMENT_SHAPE_UNSAFE")
    for path, names in contract.items():
        keys = F.col(f"_keys_{path.replace('.', '_')}")
        if path:
            code = code.when(F.coalesce(F.col(f"_kind_{path.replace('.', '_')}"), F.lit("")) != "OBJECT", "MM_DOCUMENT_SHAPE_UNSAFE")
        listed = F.array(*map(F.lit, names))
        code = code.when(F.size(F.array_except(listed, keys)) > 0, "MM_CANONICAL_FIELD_MISSING").when(F.size(F.array_except(keys, listed)) > 0, "MM_DOCUMENT_SHAPE_UNSAFE")
    code = (
        code.when(~F.coalesce(F.col("_ast") == "STRING", F.lit(False)), "MM_AST_REFERENCE_CONFLICT").when((F.size("_wrong") > 0) | F.exists("_times", lambda x: x.isNull()), "MM_GOVERNED_FIELD_TYPE_INVALID")
        .when(F.exists("_actors", lambda x: x == ""), "MM_CREATED_METADATA_INVALID")
    )
    return told.select(key, code.alias("stored_code"), *fields)


def stored_codes(df: DataFrame, document: str, key: str, kinds: dict[str, str]) -> DataFrame:
    """(key, stored_code, fields): the first thing wrong with a flat document's shape, then with its types, and the fields it concerns.

    ``kinds`` names every field that may be there and the kind its value must have.
    """
    v = F.col("_v")
    told = computed(computed(df, _v=F.try_parse_json(document)), _kind=F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0), _keys=_keys(v), _wrong=F.array_compact(F.array(*(F.when(kind_at(v, f) != k, F.lit(f)) for f, k in kinds.items()))))
    names = F.array(*map(F.lit, sorted(kinds)))
    odd = computed(told, _missing=F.array_except(names, "_keys"), _extra=F.array_except("_keys", names))
    code = (
        F.when(F.coalesce(F.col("_kind"), F.lit("")) != "OBJECT", "NOT_AN_OBJECT").when(F.size("_missing") > 0, "FIELDS_MISSING").when(F.size("_extra") > 0, "FIELDS_UNKNOWN").when(F.size("_wrong") > 0, "TYPES_WRONG")
    )
    fields = F.when(code == "FIELDS_MISSING", F.col("_missing")).when(code == "FIELDS_UNKNOWN", F.col("_extra")).when(code == "TYPES_WRONG", F.array_sort("_wrong")).otherwise(F.array().cast("array<string>"))
    return odd.select(key, code.alias("stored_code"), fields.alias("fields"))


def _agreed(*candidates: Column) -> Column:
    """The distinct candidates that aren't blank."""
    return F.array_distinct(F.filter(F.array(*candidates), lambda x: x.isNotNull() & (x != "")))


def canonical_master(df: DataFrame, document: str, key: str = "masterId", provider: str = "conlog") -> DataFrame:
    """(key, conflicts, canonical): an old master document in the canonical form, as JSON, or sorted codes of why it can't be brought there.

    Values that stand at several places must agree; blanks don't count. Identity and references are never changed.
    """
    return _canonical(df, document, key, provider).select(key, "conflicts", "canonical")


def _canonical(df: DataFrame, document: str, key: str, provider: str) -> DataFrame:
    """(key, the document, conflicts, canonical)."""
    v, id_ = F.col("_v"), F.col(key).cast("string")
    text = lambda p: F.trim(value_at(v, p))
    scalar = lambda p: F.coalesce(kind_at(v, p).isin("STRING", "BIGINT", "VOID") | kind_at(v, p).isNull(), F.lit(True))
    is_map = lambda p: F.coalesce(kind_at(v, p).isin("OBJECT", "VOID"), F.lit(True))
    area = lambda p: F.when(F.upper(text(p)).rlike(r"^ZA\d+$"), F.upper(text(p)))
    parsed = computed(df, _v=F.coalesce(F.try_parse_json(document), F.parse_json(F.lit("{}"))))
    told = computed(
        parsed,
        _raw=F.coalesce(F.nullif(F.when(kind_at(v, "meterNo") == "OBJECT", text("meterNo.raw")).when(kind_at(v, "meterNo").isin("STRING", "BIGINT"), text("meterNo")), F.lit("")), F.nullif(text("meterNo.normalized"), F.lit("")), id_), _meter_kind=F.coalesce(kind_at(v, "meterNo"), F.lit("VOID")),
        _normal=F.coalesce(F.nullif(text("meterNo.normalized"), F.lit("")), id_), _lm=_agreed(F.upper(text("lmPcode")), F.upper(text("parents.lmPcode")), F.upper(text("accessData.parents.lmPcode")), area("status.detail"), area("status.id")),
        _types=F.filter(_agreed(F.lower(text("meterType")), F.lower(text("utilityType")), F.lower(text("type"))), lambda x: x.isin("electricity", "water")), _asts=_agreed(text("refs.asts.id"), text("astId")),
        _sales=_agreed(S.meter_no(text("refs.sales.id")), S.meter_no(text("salesId"))), _providers=_agreed(F.lower(text("refs.sales.provider")), F.lower(text("salesProvider"))),
        _typed=scalar("customerNo") & scalar("accountNo") & scalar("refs.asts.id") & scalar("refs.sales.id") & scalar("refs.sales.provider") & scalar("metadata.createdByUid") & scalar("metadata.createdByUser"), _shaped=is_map("refs") & is_map("metadata"),
        _created=S.zoned_time(text("metadata.createdAt")), _updated=S.zoned_time(F.coalesce(text("metadata.updatedAt"), text("metadata.createdAt"))),
    )
    sales, owner = F.coalesce(F.get("_sales", F.lit(0)), F.lit("")), F.coalesce(F.get("_providers", F.lit(0)), F.lit(""))
    codes: Rules = [
        ("MM_AST_REFERENCE_CONFLICT", F.size("_asts") > 1), ("MM_CANONICAL_FIELD_MISSING", (F.size("_lm") == 0) | (F.size("_types") == 0)), ("MM_CREATED_METADATA_INVALID", F.col("_created").isNull() | F.col("_updated").isNull()),
        ("MM_DOCUMENT_ID_NONCANONICAL", (S.meter_no(id_) != id_) | (id_ == "")), ("MM_DOCUMENT_SHAPE_UNSAFE", ~F.col("_shaped") | ~F.col("_meter_kind").isin("STRING", "BIGINT", "OBJECT", "VOID")), ("MM_GOVERNED_FIELD_TYPE_INVALID", ~F.col("_typed")),
        ("MM_LM_CONFLICT", F.size("_lm") > 1), ("MM_METER_TYPE_CONFLICT", F.size("_types") > 1), ("MM_NORMALIZED_IDENTITY_CONFLICT", (S.meter_no("_raw") != id_) | (S.meter_no("_normal") != id_)),
        ("MM_SALES_PROVIDER_CONFLICT", (F.size("_providers") > 1) | ((owner != "") & (owner != provider)) | ((sales == "") & (owner != ""))), ("MM_SALES_REFERENCE_CONFLICT", (F.size("_sales") > 1) | ((sales != "") & (sales != id_))),
    ]
    judged = computed(told, conflicts=reasons(codes))
    blank = lambda c: F.coalesce(c, F.lit(""))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    canonical = F.to_json(F.struct(
        F.get("_lm", F.lit(0)).alias("lmPcode"), F.struct(F.col("_raw").alias("raw"), id_.alias("normalized")).alias("meterNo"), F.get("_types", F.lit(0)).alias("meterType"), blank(text("customerNo")).alias("customerNo"), blank(text("accountNo")).alias("accountNo"),
        F.struct(F.struct(blank(F.get("_asts", F.lit(0))).alias("id")).alias("asts"), F.struct(sales.alias("id"), F.when(sales != "", F.lit(provider)).otherwise("").alias("provider")).alias("sales")).alias("refs"),
        F.struct(stamp("_created").alias("createdAt"), *(F.coalesce(F.nullif(text(f"metadata.{f}"), F.lit("")), F.lit("system")).alias(f) for f in ("createdByUid", "createdByUser")), stamp("_updated").alias("updatedAt"), *(blank(text(f"metadata.{f}")).alias(f) for f in ("updatedByUid", "updatedByUser"))).alias("metadata"),
    ))
    return judged.select(key, document, "conflicts", F.when(F.size("conflicts") == 0, canonical).alias("canonical"))


def migration_plan(df: DataFrame, document: str, key: str = "masterId", provider: str = "conlog") -> DataFrame:
    """(key, classification, conflicts, canonical): CONFLICT, UNCHANGED where the document is canonical already, else UPDATED; verified by planning again."""
    made = _canonical(df.where(F.col(key).isNotNull()), document, key, provider)
    # most documents are canonical to the letter, and equal texts need no parsing; others can still say the same
    same = F.when(F.col(document) == F.col("canonical"), True).otherwise(M.same_variant(F.try_parse_json(document), F.try_parse_json("canonical")))
    state = F.when(F.size("conflicts") > 0, "CONFLICT").when(F.coalesce(same, F.lit(False)), "UNCHANGED").otherwise("UPDATED")
    return made.select(key, state.alias("classification"), "conflicts", "canonical")


def pair_issues(df: DataFrame, master: str, sales: str, key: str, lm: str | Column, provider: str) -> DataFrame:
    """The rows with ``issue``, the first thing that keeps a master and a sales document (both JSON) from being a pair, and ``visibility``, what the master's references ask for, if nothing does."""
    parsed = computed(df, _m=F.try_parse_json(master), _s=F.try_parse_json(sales))
    m, s = F.col("_m"), F.col("_s")
    place = F.lit(lm) if isinstance(lm, str) else lm
    same = lambda v, path, wanted: F.upper(F.trim(F.coalesce(value_at(v, path), F.lit("")))) == F.upper(wanted)
    is_kind = lambda v, path, *kinds: F.coalesce(kind_at(v, path).isin(*kinds), F.lit(False))
    whole = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    absent = lambda v, path: kind_at(v, path).isNull()
    id_ = F.col(key).cast("string")
    issue = (
        F.when(~whole(m), "MASTER_MISSING").when(~whole(s), "SALES_MISSING").when(~is_kind(m, "meterNo", "OBJECT") | ~same(m, "meterNo.normalized", id_), "MASTER_IDENTITY_MISMATCH").when(~same(m, "lmPcode", place), "MASTER_LM_MISMATCH")
        .when(~is_kind(m, "refs", "OBJECT") & ~absent(m, "refs"), "MASTER_REFS_INVALID").when((~is_kind(m, "refs.sales", "OBJECT") & ~absent(m, "refs.sales")) | (~is_kind(m, "refs.asts", "OBJECT") & ~absent(m, "refs.asts")), "MASTER_REFS_SHAPE_INVALID")
        .when(~same(m, "refs.sales.id", id_), "MASTER_SALES_ID_MISMATCH").when(~same(m, "refs.sales.provider", F.lit(provider)), "MASTER_SALES_PROVIDER_MISMATCH").when(~is_kind(m, "refs.asts.id", "STRING") & ~absent(m, "refs.asts.id"), "MASTER_AST_ID_NOT_STRING")
        .when(~is_kind(s, "master", "OBJECT"), "SALES_MASTER_MISSING").when(~same(s, "master.id", id_), "SALES_MASTER_ID_MISMATCH").when(~F.coalesce(value_at(s, "master.visibility").isin(*VISIBILITIES), F.lit(False)), "SALES_VISIBILITY_INVALID")
        .when(~same(s, "meterNoNormalized", id_), "SALES_IDENTITY_MISMATCH").when(~same(s, "lmPcode", place), "SALES_LM_MISMATCH").when(~same(s, "provider", F.lit(provider)), "SALES_PROVIDER_MISMATCH")
    )
    blank = lambda path: F.trim(F.coalesce(value_at(m, path), F.lit(""))) == ""
    wanted = F.when(blank("refs.asts.id") | blank("refs.sales.id"), "INVISIBLE").otherwise("VISIBLE")
    return computed(parsed, issue=issue).select(*df.columns, "issue", F.when(F.col("issue").isNull(), wanted).alias("visibility"))


def psd_rules(lm: str) -> Rules:
    """Rules for enriched meter records (MeterNumber, ErfCandidates, ErfCandidateCount, HasUsableGps, GpsMatchStatus, Sales, Units, trnBatchIds)."""
    many, gps = F.size(F.coalesce("ErfCandidates", F.array())), F.coalesce("HasUsableGps", F.lit(False))
    one = lambda f: F.get("ErfCandidates", F.lit(0))[f]
    with_one = gps & (many == 1)
    return [
        ("BLANK_METER_NUMBER", S.clean_text("MeterNumber") == ""), ("CANDIDATES_NOT_A_LIST", F.col("ErfCandidates").isNull()), ("CANDIDATE_COUNT_MISMATCH", ~F.col("ErfCandidateCount").eqNullSafe(many)), ("SEVERAL_CANDIDATES", many > 1),
        ("GPS_WITHOUT_ONE_CANDIDATE", gps & (many != 1)), ("GPS_STATUS_NOT_SINGLE", gps & (S.clean_text("GpsMatchStatus") != "MATCHED_SINGLE_GPS")), ("WRONG_MUNICIPALITY", with_one & (F.upper(S.clean_text(one("LmPcode"))) != lm)),
        ("BLANK_ERF_ID", with_one & (S.clean_text(one("ErfId")) == "")), ("BLANK_WARD", with_one & ((S.clean_text(one("WardNumber")) == "") | (S.clean_text(one("WardPcode")) == ""))),
        ("INVALID_COORDINATES", with_one & ~S.coordinate_valid(one("Latitude"), one("Longitude"))), ("CANDIDATE_WITHOUT_GPS", ~gps & (many > 0)), ("SALES_OR_UNITS_MISSING", F.col("Sales").isNull() | F.col("Units").isNull()), ("BATCH_IDS_NOT_A_LIST", F.col("trnBatchIds").isNull()),
    ]


def psd_outputs(df: DataFrame) -> dict[str, DataFrame]:
    """The outputs of enriched meter records: main rows, one row for each candidate, unmatched meters, and a summary."""
    main = df.drop("ErfCandidates")
    candidates = df.select("MeterNumber", F.posexplode("ErfCandidates").alias("place", "c")).select("MeterNumber", F.col("place") + 1, "c.*").withColumnRenamed("(place + 1)", "place")
    unmatched = df.where(~F.coalesce("HasUsableGps", F.lit(False))).select("MeterNumber", "GpsMatchStatus")
    summary = df.groupBy("GpsMatchStatus").agg(F.count("*").alias("meters"), F.count_if("HasUsableGps").alias("withGps"), F.sum(F.size("ErfCandidates")).alias("candidates"))
    return {"main": main, "candidates": candidates, "unmatched": unmatched, "summary": summary}
