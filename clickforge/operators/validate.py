"""Set-oriented ingest validation.

Input is a DataFrame of JSONL lines (see :func:`clickforge.sources.raw.read_lines`) with
``file_path, event_type, block_start, line_id, line, v`` where ``v`` is the parsed
``variant`` (null for blank and non-JSON lines). The rule table (:mod:`clickforge.rules`) is
compiled: each event type's profile becomes flat Column expressions over the fields that it
rules, extracted once, without maps, higher-order functions, UDFs or per-file Python
loops. Files of all event types are validated in one pass: the file's event type picks the branch.

Per record the checks run in the reference order: unknown type (single error), required
fields (missing / JSON null; if any fire, nothing else is checked), types, enums (even
when the type check failed), ranges (numbers only), timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.functions.columns import materialize
from clickforge.rules import ISO8601_PATTERN, PROFILES

# Error message formats of the ingest validator.
MSG_UNKNOWN_TYPE = "Tipo de evento desconocido: '{}'"
MSG_MISSING = "Campo obligatorio faltante: '{}'"
MSG_NULL = "Campo obligatorio es null: '{}'"
MSG_TYPE = "'{}' debe ser {}, recibido {}"
MSG_ENUM = "'{}' valor invalido: '{}'"
MSG_RANGE = "'{}' fuera de rango [{}, {}]: {}"
MSG_TS_TYPE = "timestamp debe ser string, recibido {}"
MSG_TS_FORMAT = "timestamp no tiene formato ISO8601: '{}'"
EXPECTED_NAME = {"str": "str", "num": "int o float", "int": "int"}

def _py_type(t: Column) -> Column:
    """Python type name of a parsed JSON value (used in messages and kind checks), from the
    variant's schema ``t``, a column of the plan.

    The variant parser keeps integer literals as BIGINT and any literal with a fraction
    or exponent as DECIMAL/DOUBLE (``46.0`` becomes ``DECIMAL(2,0)``), so a DECIMAL is a
    Python ``float``, unless it has more digits than a BIGINT holds and no fraction: then
    it was an integer literal (the parser drops the fraction of shorter ones only).
    """
    digits = F.regexp_extract(t, r"^DECIMAL\(([0-9]+),0\)$", 1).try_cast("int")
    return (F.when(t == "STRING", "str")
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | (digits >= 19), "int")
             .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
             .when(t == "BOOLEAN", "bool")
             .when(t.startswith("ARRAY"), "list")
             .when(t.startswith("OBJECT"), "dict")
             .when(t == "VOID", "NoneType")
             .otherwise(F.lower(t)))


def _as_text(fv: Column, pt: Column) -> Column:
    """``str(value)`` as Python would print it for scalars (a float always shows a
    fractional part: ``0.0``)."""
    num = F.try_variant_get(fv, "$", "string")
    whole_float = (pt == "float") & ~num.contains(".") & ~F.lower(num).contains("e")
    return (F.when(pt == "str", num)
             .when(pt == "bool", F.when(F.try_variant_get(fv, "$", "boolean"), "True")
                                  .otherwise("False"))
             .when((pt == "float") & num.endswith("Infinity"),
                   F.replace(num, F.lit("Infinity"), F.lit("inf")))
             .when(whole_float, F.concat(num, F.lit(".0")))
             .when(pt.isin("int", "float"), num)
             .otherwise(F.to_json(fv)))


def _err(code, field, reason: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    field = F.lit(field).cast("string") if field is None or isinstance(field, str) else field
    return F.struct(code.alias("code"), field.alias("field"), reason.alias("reason"))


def _fmt(msg: str, *args: Column) -> Column:
    return F.format_string(msg.replace("{}", "%s"), *args)


NO_ERRORS = "array<struct<code:string,field:string,reason:string>>"


#: Slots or checks whose code goes into one generated method.
STAGE = 3


class _Compiled:
    """A rule profile compiled to flat Columns over slots.

    The ruled fields of an event type, required ones first, have places: its slots. Slot ``p`` of
    a record is the field that its own type has there, so the code grows with the widest type,
    not with all types' rules. Columns of the plan: ``_x<p>`` the field's variant (null where it
    is missing), ``_t<p>`` its Python type name.
    """

    def __init__(self, rules: dict):
        self.rules, self.fields = rules, {}
        for et, spec in rules.items():
            own = list(dict.fromkeys([*spec["required"], *spec["types"], *spec["enums"], *spec["ranges"], "timestamp"]))
            self.fields[et] = own
            for part in ("types", "enums", "ranges"):
                places = [own.index(f) for f in spec[part]]
                if places != sorted(places) or own[:2] != ["user_id", "session_id"]:
                    raise ValueError(f"the rules of {et} name their fields in different orders")
        self.width = max(map(len, self.fields.values()))
        self.known = F.col("event_type").isin(list(rules))

    def by_type(self, place: int, rule) -> dict:
        """``rule(spec, field)`` of the types that have a slot ``place``, with their names; types
        without such a rule are left out."""
        out = {}
        for et, own in self.fields.items():
            found = rule(self.rules[et], own[place]) if place < len(own) else None
            if found is not None:
                out.setdefault(repr(found), (found, []))[1].append(et)
        return out

    def pick(self, place: int, rule, value) -> Column | None:
        """``value(rule)`` by the record's type; null for types without the rule."""
        out = None
        for found, types in self.by_type(place, rule).values():
            case = F.when if out is None else out.when
            out = case(F.col("event_type").isin(types), value(found))
        return out

    def field(self, place: int) -> Column:
        return F.get("_fields", F.lit(place))

    def extracted(self, records: DataFrame) -> DataFrame:
        """Adds the slots: only ruled fields are read from the variant, each once."""
        names, required = F.array().cast("array<string>"), F.lit(0)
        for et, own in self.fields.items():
            own_type = F.col("event_type") == et
            names = F.when(own_type, F.array(*map(F.lit, own))).otherwise(names)
            required = F.when(own_type, len(self.rules[et]["required"])).otherwise(required)
        slots = {}
        for p in range(self.width):
            read = self.pick(p, lambda spec, f: f, lambda f: F.try_variant_get("v", f"$.{f}", "variant"))
            if p < 2:  # read of unknown types too
                read = F.try_variant_get("v", f"$.{next(iter(self.fields.values()))[p]}", "variant")
            slots[f"_x{p}"] = read
        df = materialize(records, _fields=names, _required=required, **slots)
        df = materialize(df, **{f"_s{p}": F.schema_of_variant(f"_x{p}") for p in range(self.width)})
        return self._staged(df, {f"_t{p}": _py_type(F.col(f"_s{p}")) for p in range(self.width)})

    @staticmethod
    def _staged(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
        """Adds columns ``STAGE`` at a time: each stage is a generated method of its own, small
        enough for the JVM to compile it."""
        names = list(cols)
        for k in range(0, len(names), STAGE):
            df = materialize(df, **{n: cols[n] for n in names[k:k + STAGE]})
        return df

    @staticmethod
    def _listed(df: DataFrame, name: str, where: Column, checks: list[tuple[Column, Column]],
                stage: int = STAGE) -> tuple[DataFrame, list]:
        """``df`` with columns that list the errors of the checks whose condition holds (null: it
        does not), in order, for records ``where`` they apply; and the columns' names."""
        none, names = F.array().cast(NO_ERRORS), []
        for k in range(0, len(checks), stage):
            some = F.concat(none, *[F.when(cond, F.array(error)).otherwise(none) for cond, error in checks[k:k + stage]])
            names.append(f"{name}{k}")
            df = materialize(df, **{names[-1]: F.when(where, some).otherwise(none)})
        return df, names

    def required(self) -> list:
        """Missing and null required fields."""
        out = []
        for p in range(max(len(spec["required"]) for spec in self.rules.values())):
            x, f = F.col(f"_x{p}"), self.field(p)
            gone = x.isNull()
            out.append(((F.col("_required") > p) & (gone | (F.col(f"_t{p}") == "NoneType")), _err(
                F.when(gone, "missing_field").otherwise("null_field"), f,
                F.when(gone, _fmt(MSG_MISSING, f)).otherwise(_fmt(MSG_NULL, f)))))
        return out

    def types(self) -> list:
        out = []
        for p in range(self.width):
            pt = F.col(f"_t{p}")

            def rule(spec, f):
                return spec["types"].get(f)

            wrong = self.pick(p, rule, lambda kind, pt=pt: ~_kind_ok(pt, kind))
            if wrong is not None:
                expected = self.pick(p, rule, lambda kind: F.lit(EXPECTED_NAME[kind]))
                out.append((wrong, _err("wrong_type", self.field(p), _fmt(MSG_TYPE, self.field(p), expected, pt))))
        return out

    def enums(self) -> list:
        out = []
        for p in range(self.width):
            x, pt = F.col(f"_x{p}"), F.col(f"_t{p}")
            wrong = self.pick(p, lambda spec, f: spec["enums"].get(f), lambda vals, x=x, pt=pt: (
                (pt != "str") | ~F.try_variant_get(x, "$", "string").isin(vals)))
            if wrong is not None:
                out.append((wrong, _err("invalid_enum", self.field(p), _fmt(
                    MSG_ENUM, self.field(p), _as_text(x, pt)))))
        return out

    def ranges(self) -> list:
        out = []
        for p in range(self.width):
            x, pt = F.col(f"_x{p}"), F.col(f"_t{p}")
            # a boolean counts as 0 or 1
            number = F.when(pt == "bool", F.try_variant_get(x, "$", "boolean").cast("double")) \
                .otherwise(F.try_variant_get(x, "$", "double"))

            def rule(spec, f):
                return spec["ranges"].get(f)

            wrong = self.pick(p, rule, lambda r, pt=pt, number=number: (
                pt.isin("int", "float", "bool") & ~number.between(float(r[0]), float(r[1]))))
            if wrong is not None:
                low, high = (self.pick(p, rule, lambda r, k=k: F.lit(str(r[k]))) for k in (0, 1))
                out.append((wrong, _err("out_of_range", self.field(p), _fmt(
                    MSG_RANGE, self.field(p), low, high, _as_text(x, pt)))))
        return out

    def timestamp(self) -> tuple[Column, Column]:
        x, pt = F.lit(None), F.lit(None).cast("string")
        for p in range(self.width):
            own = self.pick(p, lambda spec, f: f if f == "timestamp" else None, lambda f: F.lit(True))
            if own is not None:
                x = F.when(own, F.try_variant_get(f"_x{p}", "$", "string")).otherwise(x)
                pt = F.when(own, F.col(f"_t{p}")).otherwise(pt)
        return x, pt

    def errors(self, df: DataFrame) -> DataFrame:
        """``df`` with the slots, and ``errors`` of every record (empty: valid)."""
        record = F.col("is_record")
        df, lacks = self._listed(df, "_lacks", record, self.required())
        text, pt = self.timestamp()
        lacking = F.concat(*lacks)
        df = materialize(df, _lacks=lacking, _checked=record & self.known & (F.size(lacking) == 0), _ts=text, _tt=pt)
        stamps = [(F.col("_tt") != "str", _err("timestamp_type", "timestamp", _fmt(MSG_TS_TYPE, F.col("_tt")))),
                  ((F.col("_tt") == "str") & ~F.col("_ts").rlike(ISO8601_PATTERN),
                   _err("timestamp_format", "timestamp", _fmt(MSG_TS_FORMAT, F.col("_ts"))))]
        listed = []
        for name, checks, stage in (("_types", self.types(), STAGE), ("_values", self.enums() + self.ranges(), 1),
                                    ("_stamps", stamps, STAGE)):
            df, more = self._listed(df, name, F.col("_checked"), checks, stage)
            listed += more
        unknown = F.array(_err("unknown_event_type", None, _fmt(MSG_UNKNOWN_TYPE, F.col("event_type"))))
        return materialize(df, errors=F.when(record, F.when(~self.known, unknown).otherwise(
            F.concat("_lacks", *listed))))


def _kind_ok(pt: Column, kind: str) -> Column:
    # "num": a JSON boolean passes, as Python's bool is an int.
    return {"str": pt == "str", "num": pt.isin("int", "float", "bool"), "int": pt == "int"}[kind]


def annotate(lines: DataFrame, profile: str = "ingest") -> DataFrame:
    """V2-V7: add ``is_record`` (a parsed JSON line), ``errors`` (array, empty when
    valid, null for non-records), ``err_user_id`` / ``err_session_id`` as the validator
    reports them (``"unknown"`` when missing, null when JSON null).

    A JSON line that is not an object counts as a record with every field missing.
    """
    rules = _Compiled(PROFILES[profile])
    df = rules.extracted(lines.withColumn("is_record", F.col("v").isNotNull()))

    def ident(p):
        x, pt = F.col(f"_x{p}"), F.col(f"_t{p}")
        return F.when(x.isNull(), "unknown").when(pt != "NoneType", _as_text(x, pt))

    is_rec = F.col("is_record")
    df = materialize(df, err_user_id=F.when(is_rec, ident(0)), err_session_id=F.when(is_rec, ident(1)))
    return rules.errors(df).select(*lines.columns, "is_record", "errors", "err_user_id", "err_session_id")


def with_record_index(ann: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Records with errors and their position among the parsed records of their file
    (0-based). ``records`` are the parsed lines that ``ann`` was made from: records are
    counted from them, so that the count does not run the checks a second time.

    Exact and skew-proof: a window per *split* (file, block_start) - bounded by the
    maximum split size - counts records before each line in scan order; a second window
    over the small per-split count table gives each split's offset in its file. Only a
    narrow projection (no line text) is shuffled.
    """
    split = ["file_path", "block_start"]
    narrow = ann.filter(F.col("is_record")).select(
        *split, "line_id", "errors", "err_user_id", "err_session_id", "event_type")
    w = Window.partitionBy(*split).orderBy("line_id")
    local = narrow.withColumn("_local", F.row_number().over(w) - 1)
    parsed = narrow if records is None else records.filter(F.col("v").isNotNull())
    counts = parsed.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"))
    wf = Window.partitionBy("file_path").orderBy("block_start") \
               .rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(wf), F.lit(0))) \
                    .drop("_n")
    return local.filter(F.size("errors") > 0).join(offsets, split).withColumn(
        "record_index", (F.col("_offset") + F.col("_local")).cast("long")) \
        .drop("_offset", "_local")


def validation_errors(ann: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """V8: one row per error ``(file_path, event_type, record_index, user_id, session_id,
    error_code, field, reason)``."""
    idx = with_record_index(ann, records)
    return idx.select("file_path", "event_type", "record_index",
                      F.col("err_user_id").alias("user_id"),
                      F.col("err_session_id").alias("session_id"),
                      F.explode("errors").alias("e")).select(
        "file_path", "event_type", "record_index", "user_id", "session_id",
        F.col("e.code").alias("error_code"), F.col("e.field").alias("field"),
        F.col("e.reason").alias("reason"))


def validation_summary(ann: DataFrame) -> DataFrame:
    """V8/V11 per file: ``valid_count`` (records), ``invalid_count`` (errors, as the
    reference counts them), ``invalid_records``, ``skipped_lines`` (non-JSON), file size."""
    n_err = F.when(F.col("is_record"), F.size("errors")).otherwise(0)
    skipped = ~F.col("is_record") & (F.trim("line") != "")
    return ann.groupBy("file_path", "event_type").agg(
        F.max("file_size").alias("file_size"),
        F.count_if(F.col("is_record")).alias("records"),
        F.count_if(F.col("is_record") & (n_err == 0)).alias("valid_count"),
        F.sum(n_err).cast("long").alias("invalid_count"),
        F.count_if(n_err > 0).alias("invalid_records"),
        F.count_if(skipped).alias("skipped_lines"))


def ingest_metrics(summary: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """V9 + V11 per file: the counters the ingest function publishes. ``listing``
    (``file_path, file_size`` of every input file, see
    :func:`clickforge.sources.raw.list_files`) adds files that have no line at all; files
    with zero parsed records count as empty. A listed file that has bytes but gave no line
    could not be read and counts as a processing error instead."""
    s = summary
    unread = F.lit(False)
    if listing is not None:
        from clickforge.sources.raw import event_type_from_path
        s = listing.join(summary.drop("file_size", "event_type"), "file_path", "left") \
                   .withColumn("event_type", event_type_from_path(F.col("file_path")))
        unread = F.col("records").isNull() & (F.col("file_size") > 0)
    records = F.coalesce("records", F.lit(0))
    empty = records == 0
    inv = F.coalesce("invalid_count", F.lit(0))
    return s.select(
        "file_path", "event_type",
        F.when(empty & ~unread, 1).otherwise(0).alias("EmptyFiles"),
        F.when(empty, 0).otherwise(1).alias("FilesProcessed"),
        F.when(~empty & (inv > 0), 1).otherwise(0).alias("FilesWithErrors"),
        F.when(empty, 0).otherwise(inv).cast("long").alias("InvalidRecords"),
        F.when(empty, 0).otherwise(F.coalesce("valid_count", F.lit(0))).cast("long")
         .alias("ValidRecords"),
        F.when(empty, 0).otherwise(F.col("file_size")).cast("long").alias("FileSizeBytes"),
        F.when(unread, 1).otherwise(0).alias("ProcessingErrors"))


def run_summary(metrics: DataFrame) -> DataFrame:
    """``processed_files`` and ``total_errors`` over a run."""
    return metrics.agg(
        F.coalesce(F.sum("FilesProcessed"), F.lit(0)).cast("long").alias("processed_files"),
        F.coalesce(F.sum("InvalidRecords"), F.lit(0)).cast("long").alias("total_errors"))


def valid_events(ann: DataFrame) -> DataFrame:
    """``(file_path, event_type, block_start, line_id, line)`` of every record that passed
    all checks (the trimmed JSON text, ready for a typed JSON parse), with its place in scan
    order. Nothing is shuffled."""
    return ann.filter(F.col("is_record") & (F.size("errors") == 0)).select(
        "file_path", "event_type", "block_start", "line_id", F.trim("line").alias("line"))


def error_counts(errors: DataFrame, by=("event_type", "error_code", "field")) -> DataFrame:
    """Errors per reason class (for reports and tests)."""
    return errors.groupBy(*by).agg(F.count(F.lit(1)).alias("errors"))
