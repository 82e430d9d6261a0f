"""Checks of a written data set, over VARIANT, so that missing, null, wrong type and float stay apart.

Errors come as rows (phase, sample_ord, view_ord, item, rule, message) in the order of one final sort. Payloads of the
wrong shape give an error row, never a crash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ACTION_WORDS, CATEGORIES, MANGA_FORBIDDEN_TERMS
from ..functions import text as X

ERROR = "struct<view_ord:int,item:int,rule:int,message:string>"


def _kind(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v), F.lit("MISSING"))


def _is(v: Column, kind: str) -> Column:
    return _kind(v).startswith(kind)


def _get(v: Column, name: str) -> Column:
    return F.when(_is(v, "OBJECT"), F.try_variant_get(v, f"$.{name}", "variant"))


def _fields(v: Column, *names: str) -> Column:
    """The fields of an object, all read at once; null for what is no object."""
    return F.try_variant_get(v, "$", f"struct<{','.join(f'{n}:variant' for n in names)}>")


def _items(v: Column, *names: str) -> Column:
    """The items of a list by their fields (null for an item that is no object); null for what is no list."""
    return F.try_variant_get(v, "$", f"array<struct<{','.join(f'{n}:variant' for n in names)}>>")


def _said(v: Column) -> Column:
    """The text of a value: null for a missing one; a JSON null is the word None, as other values have a text of theirs."""
    return X.bound(_kind(v), lambda k: F.when(k == "VOID", F.lit("None")).when(k.startswith("STRING"), F.try_variant_get(v, "$", "string")).when(v.isNotNull(), F.to_json(v)))


def _lacking(v: Column) -> Column:
    """Whether there is no text: a missing value or a blank one. Values of other kinds have a text that isn't blank."""
    return F.coalesce(~F.is_variant_null(v) & X.blank(F.try_variant_get(v, "$", "string")), F.lit(True))


def valid_box(v: Column, width: Column, height: Column) -> Column:
    """A list of four whole numbers (true and false count as 1 and 0) inside the canvas, not empty."""
    whole = lambda p: X.bound(_kind(p), lambda k: F.when(k == "BIGINT", F.try_variant_get(p, "$", "bigint")).when(k == "BOOLEAN", F.try_variant_get(p, "$", "boolean").cast("bigint")))

    def inside(n: Column) -> Column:
        a, b, c, d = (F.get(n, i) for i in range(4))
        return (F.size(n) == 4) & F.forall(n, lambda x: x.isNotNull()) & (a >= 0) & (a < c) & (c <= width) & (b >= 0) & (b < d) & (d <= height)

    return F.coalesce(X.bound(F.transform(F.try_variant_get(v, "$", "array<variant>"), whole), inside), F.lit(False))


def _error(view: int, item: Column, rule: int, message: Column) -> Column:
    return F.struct(F.lit(view).alias("view_ord"), item.cast("int").alias("item"), F.lit(rule).alias("rule"), message.alias("message"))


def _list(*errors: tuple[Column, Column]) -> Column:
    """The errors whose condition holds."""
    none = F.lit(None).cast(ERROR)
    return F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), e).otherwise(none) for c, e in errors]), lambda e: e.isNotNull())


def _each(items: Column, errors) -> Column:
    return F.coalesce(F.flatten(F.transform(items, lambda x, i: errors(x, i + 1))), F.array().cast(f"array<{ERROR}>"))


def _item(view: int, x: Column, i: Column, where: Column, w: Column, h: Column) -> list[tuple[Column, Column]]:
    shown = X.bound(F.coalesce(F.regexp_replace(F.to_json(x["bbox_2d"]), ",", ", "), F.lit("None")), lambda b: F.when(b == "null", "None").otherwise(b))
    ok = x.isNotNull()
    return [(~ok, _error(view, i, 0, F.concat(where, F.lit(": expected object")))), (ok & ~valid_box(x["bbox_2d"], w, h), _error(view, i, 1, F.concat(where, F.lit(": invalid bbox_2d "), shown))), (ok & _lacking(x["text"]), _error(view, i, 2, F.concat(where, F.lit(": missing text"))))]


def _at(context: Column, mark: str, i: Column) -> Column:
    return F.concat(context, F.lit(f"{mark}["), i.cast("string"), F.lit("]"))


def vlm_errors(v: Column, items: Column, w: Column, h: Column, context: Column) -> Column:
    """v: _fields() of the view, items: _items() of its content; likewise below."""
    zero, ok = F.lit(0), v.isNotNull()
    top = _list((~ok, _error(1, zero, 0, F.concat(context, F.lit(": expected object")))), (ok & ~F.coalesce(_said(v["category"]).isin(*CATEGORIES), F.lit(False)), _error(1, zero, 1, F.concat(context, F.lit(": category must be manga or game")))), (ok & items.isNull(), _error(1, zero, 2, F.concat(context, F.lit(": content must be list")))))
    each = lambda x, i: _list(*_item(1, x, i, _at(context, ":content", i), w, h), (x.isNotNull() & _lacking(x["translated_text"]), _error(1, i, 3, F.concat(_at(context, ":content", i), F.lit(": missing translated_text")))))
    return F.concat(top, _each(items, each))


def ocr_errors(items: Column, w: Column, h: Column, context: Column) -> Column:
    top = _list((items.isNull(), _error(2, F.lit(0), 0, F.concat(context, F.lit(": expected list")))))
    return F.concat(top, _each(items, lambda x, i: _list(*_item(2, x, i, _at(context, "", i), w, h))))


def trans_errors(items: Column, context: Column) -> Column:
    top = _list((items.isNull(), _error(3, F.lit(0), 0, F.concat(context, F.lit(": expected list")))))

    def each(x: Column, i: Column) -> Column:
        ok, where = x.isNotNull(), _at(context, "", i)
        lack = [(ok & x["id"].isNull(), 1, "id"), (ok & _lacking(x["text"]), 2, "text"), (ok & _lacking(x["translated_text"]), 3, "translated_text")]
        return _list((~ok, _error(3, i, 0, F.concat(where, F.lit(": expected object")))), *[(c, _error(3, i, r, F.concat(where, F.lit(f": missing {n}")))) for c, r, n in lack])

    return F.concat(top, _each(items, each))


def canonical_errors(v: Column, items: Column, context: Column) -> Column:
    zero, ok = F.lit(0), v.isNotNull()
    lines = F.filter(items, lambda x: x.isNotNull())
    languages = F.array_sort(F.array_distinct(F.transform(lines, lambda x: F.coalesce(_said(x["source_language"]), F.lit("None")))))
    shown = lambda found: F.concat(F.lit("["), F.concat_ws(", ", F.transform(found, lambda x: F.when(x == "None", x).otherwise(F.concat(F.lit("'"), x, F.lit("'"))))), F.lit("]"))
    mixed = X.bound(languages, lambda found: F.when(F.size(found) > 1, shown(found)))
    top = _list((~ok, _error(4, zero, 0, F.concat(context, F.lit(": expected object")))), (ok & items.isNull(), _error(4, zero, 1, F.concat(context, F.lit(": content must be list")))))
    top = F.concat(top, X.bound(mixed, lambda m: _list((m.isNotNull(), _error(4, zero, 2, F.concat(context, F.lit(": mixed source languages "), m))))))
    manga = F.coalesce(_said(v["category"]) == "manga", F.lit(False))

    def each(x: Column, i: Column) -> Column:
        inner, where = x.isNotNull(), _at(context, ":content", i)
        folded = lambda n: X.fold(F.coalesce(_said(x[n]), F.lit("")))
        return X.bound(F.struct(folded("text").alias("text"), folded("translated_text").alias("translated_text")), lambda f: _list((~inner, _error(4, i, 0, F.concat(where, F.lit(": expected object")))), (inner & F.coalesce(_said(x["kind"]) == "sfx", F.lit(False)), _error(4, i, 1, F.concat(where, F.lit(": sfx kind is not allowed in default dataset")))),
                     (inner & (X.contains_any(f["text"], ACTION_WORDS) | X.contains_any(f["translated_text"], ACTION_WORDS)), _error(4, i, 2, F.concat(where, F.lit(": action/sfx word leaked into text")))), (inner & X.contains_any(f["text"], MANGA_FORBIDDEN_TERMS) & manga, _error(4, i, 3, F.concat(where, F.lit(": game term leaked into manga text"))))))

    return F.concat(top, _each(items, each))


def sample_errors(samples: DataFrame) -> DataFrame:
    """samples: sample_ord, id, image, width, height (null: no image), vlm, ocr, trans, canonical as JSON text.

    Each view is taken apart once, by columns of their own; what looks at an item finds its fields there."""
    s = samples.withColumns({f"{n}_v": F.try_parse_json(n) for n in ("vlm", "ocr", "trans", "canonical")})
    s = s.withColumns({"vlm_v": _fields(F.col("vlm_v"), "category", "content"), "canonical_v": _fields(F.col("canonical_v"), "category", "content")})
    s = s.withColumns({"vlm_i": _items(F.col("vlm_v")["content"], "bbox_2d", "text", "translated_text"), "ocr_i": _items(F.col("ocr_v"), "bbox_2d", "text"), "trans_i": _items(F.col("trans_v"), "id", "text", "translated_text"), "canonical_i": _items(F.col("canonical_v")["content"], "text", "translated_text", "source_language", "kind")})
    v, items, context = lambda n: F.col(f"{n}_v"), lambda n: F.col(f"{n}_i"), lambda n: F.concat("id", F.lit(f":{n}"))
    w, h = F.col("width"), F.col("height")
    n = [F.size(items(x)) for x in ("vlm", "ocr", "trans")]
    differ = _list((~((n[0] == n[1]) & (n[0] == n[2])), _error(5, F.lit(0), 0, F.concat("id", F.lit(": output line counts differ")))))
    present = F.concat(vlm_errors(v("vlm"), items("vlm"), w, h, context("vlm")), ocr_errors(items("ocr"), w, h, context("ocr")), trans_errors(items("trans"), context("trans")), canonical_errors(v("canonical"), items("canonical"), context("canonical")), differ)
    missing = F.array(_error(0, F.lit(0), 0, F.concat("id", F.lit(": missing image "), "image")))
    errors = F.when(w.isNull(), missing).otherwise(present)
    return s.select(F.lit(1).alias("phase"), "sample_ord", F.explode(errors).alias("e")).select("phase", "sample_ord", "e.*")


def chat_errors(chat: DataFrame, vlm: DataFrame) -> DataFrame:
    """chat: chat_ord, record (JSON text). vlm: id, vlm. A sample without either side is fine."""
    c = chat.withColumn("v", F.try_parse_json("record")).withColumn("id", F.coalesce(_said(_get(F.col("v"), "id")), F.lit("<unknown>")))
    messages = F.when(_is(_get(F.col("v"), "messages"), "ARRAY"), _get(F.col("v"), "messages").cast("array<variant>"))
    c = c.withColumn("n", F.coalesce(F.size(messages), F.lit(0))).withColumn("said", F.when(F.col("n") == 2, F.try_variant_get(F.get(messages, 1), "$.content", "string")))
    c = c.withColumn("answer", F.try_parse_json("said")).select("chat_ord", "id", "n", F.to_json("answer").alias("answer"))
    joined = c.join(vlm.select("id", F.to_json(F.try_parse_json("vlm")).alias("own")), "id", "left")
    message = (
        F.when(F.col("n") != 2, F.lit(": chat must have user and assistant messages"))
        .when(F.col("answer").isNull(), F.lit(": assistant content is not JSON"))
        .when(F.col("own").isNotNull() & (F.col("own") != F.col("answer")), F.lit(": chat assistant JSON does not match vlm output"))
    )
    return joined.filter(message.isNotNull()).select(F.lit(2).alias("phase"), F.col("chat_ord").alias("sample_ord"), F.lit(0).alias("view_ord"), F.lit(0).alias("item"), F.lit(0).alias("rule"), F.concat("id", message).alias("message"))


def ordered(errors: DataFrame) -> DataFrame:
    return errors.orderBy("phase", "sample_ord", "view_ord", "item", "rule")
