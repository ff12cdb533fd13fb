"""Message → canonical event or dead letter, entirely as JVM-side Column expressions.

The first failure wins, in the order the proxy converter reads its fields: process type,
destination_ip, source_ip, bytes_sent, bytes_received, destination_port, user, request_timestamp.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventwatch.config import DEFAULT_PAYLOAD_TYPE

# Fixed reason texts (prefixes and field messages).
PARSE_PREFIX = "Failed to parse: "
INVALID_PREFIX = "Invalid payload: "
PARSE_MESSAGE = "malformed JSON"
NOT_OBJECT = "not an object"
TYPE_A_MESSAGE = "type A parser not yet implemented"
NULL_TIMESTAMP = "null"

INT_FIELDS = {"bytes_sent": "bytesSent", "bytes_received": "bytesReceived", "destination_port": "destinationPort"}
MAX_EPOCH_MS = (2 ** 63 - 1) // 1000   # timestamps are 64-bit microseconds: about 290,000 years either way
_INT32 = 2 ** 32
_INT31 = 2 ** 31
_CHUNK = 10 ** 9
JSON_SPACE = " \t\r\n"
_NUMBER = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?$"   # sign, whole digits, fraction, exponent


def payload_text(payload: Column) -> Column:
    """UTF-8 decode; invalid bytes become U+FFFD instead of failing the query."""
    return F.make_valid_utf8(payload.cast("string"))


def wrapped(text: Column) -> Column:
    """The text parsed as the one element of an array (null if malformed): text behind a document is then an error."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def only_document(array: Column, text: Column, kind: str = "variant") -> Column:
    """The document that ``wrapped`` parsed as ``kind``, null if the text is not exactly one or not of that kind. Repeated keys,
    nested ones too, make a text malformed. A text that closes the array itself does not parse as a member of an object."""
    closes = text.contains("]") & F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}"))).isNull()
    return F.when(F.try_variant_get(array, "$[1]", "variant").isNull() & ~closes, F.try_variant_get(array, "$[0]", kind))


def _present(t: Column) -> Column:
    return t.isNotNull() & (t != "VOID")


def _is_number(t: Column) -> Column:
    return t.startswith("DECIMAL") | t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def _mod32(digits: Column) -> Column:
    """A string of decimal digits of any length, modulo 2^32. As 2^32 divides 10^32, the last 32 digits decide."""
    return F.pmod(F.right(digits, F.lit(32)).try_cast("decimal(38,0)"), F.lit(_INT32).cast("decimal(38,0)")).cast("long")


def exact_low32(number: Column) -> Column:
    """Low 32 bits, two's complement, of a JSON number's text truncated toward zero; exact for any length and exponent."""
    whole, part = F.regexp_extract(number, _NUMBER, 2), F.regexp_extract(number, _NUMBER, 3)
    power = F.regexp_extract(number, _NUMBER, 4)
    # An exponent of more than nine digits moves the point out of any text's reach.
    shift = (F.when(power == "", F.lit(0)).when(F.length(F.regexp_replace(power, "^[+-]?0*", "")) <= 9, power.try_cast("int"))
             .when(power.startswith("-"), F.lit(-_CHUNK)).otherwise(F.lit(_CHUNK)))
    kept = F.length(whole).cast("long") + shift
    digits = F.concat(whole, part)
    cut = F.when(kept > 0, F.substring(digits, F.lit(1), F.least(kept, F.length(digits).cast("long")).cast("int"))).otherwise(F.lit("0"))
    zeros = F.greatest(kept - F.length(digits), F.lit(0))
    # 2^32 divides 10^32: from there on nothing is left of the low bits.
    low = F.when(zeros < 32, _mod32(F.concat(cut, F.repeat(F.lit("0"), zeros.cast("int"))))).otherwise(F.lit(0).cast("long"))
    return _low32(F.when(F.regexp_extract(number, _NUMBER, 1) == "-", -low).otherwise(low))


def numbers_as_strings(text: Column) -> Column:
    """A JSON text with every number in quotes, so that its own characters can be read. The marks used on the way are
    control characters, which a valid text does not hold."""
    slash, quote, mark = "\x03", "\x04", "\x01"
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(slash)), F.lit('\\"'), F.lit(quote))   # strings end at the next quote
    marked = F.regexp_replace(plain, r'("[^"]*+")|(-?[0-9][0-9.eE+-]*)', f"$1{mark}$2{mark}")     # a string, or a number
    quoted = F.replace(F.replace(marked, F.lit(mark + mark), F.lit("")), F.lit(mark), F.lit('"'))
    return F.replace(F.replace(quoted, F.lit(quote), F.lit('\\"')), F.lit(slash), F.lit("\\\\"))


FieldRef = dict  # field name → {"t": JSON type, "s": text form, "n": whether a number, "b": 64-bit integer form, "digits": own characters}


def bind(df: DataFrame, *cols: Column) -> DataFrame:
    """Compute ``cols`` once per row and expose them as columns.

    A one-row ``inline`` generator is an optimizer barrier: later filters on values derived from
    these columns (e.g. ``failure_reason IS NULL``) cannot be pushed below it, so Catalyst does not
    inline the JSON parse into every reference.  Codegen'd, no shuffle.
    """
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def extract_fields(df: DataFrame, text: str, fields: dict[str, str]) -> tuple[DataFrame, dict[str, dict[str, Column]]]:
    """Read the top-level ``fields`` of a JSON text once.  ``fields``: name → 'string', 'int' or 'number'.

    The text's parsed form, ``{text}_array`` (``wrapped``), is cut into a small Variant per field; then each field's JSON
    type, and only the form that type needs: text for strings, a 64-bit integer (truncated toward zero)
    for numbers.  ``digits`` reads an integer field's own characters, for the rare number that a 64-bit integer
    or a double does not hold exactly.
    """
    schema = "struct<" + ", ".join(f"`{f}`: variant" for f in fields) + ">"
    if f"{text}_array" not in df.columns:
        df = bind(df, wrapped(F.col(text)).alias(f"{text}_array"))
    exact = F.from_json(numbers_as_strings(F.col(text)), "struct<" + ", ".join(f"`{f}`: string" for f, k in fields.items() if k == "int") + ">")
    doc = bind(df, only_document(F.col(f"{text}_array"), F.col(text), schema).alias("__doc")).drop(f"{text}_array")
    typed = bind(doc, *[F.schema_of_variant(F.col("__doc").getField(f)).alias(f"__t_{f}") for f in fields])
    cols, refs = [], {}
    for f, kind in fields.items():
        t, fv = F.col(f"__t_{f}"), F.col("__doc").getField(f)
        cols.append(F.when(t == "STRING", F.variant_get(fv, "$", "string")).alias(f"__s_{f}"))
        if kind in ("int", "number"):
            cols += [_is_number(t).alias(f"__n_{f}"), F.when(_is_number(t), F.try_variant_get(fv, "$", "bigint")).alias(f"__b_{f}")]
        refs[f] = {"t": t, "s": F.col(f"__s_{f}"), "digits": exact.getField(f) if kind == "int" else None,
                   "n": F.col(f"__n_{f}") if kind != "string" else None,
                   "b": F.col(f"__b_{f}") if kind != "string" else F.lit(None)}
    return bind(typed, *cols), refs


def _low32(b: Column) -> Column:
    """Low 32 bits of a 64-bit integer as a signed int (bit mask: no overflow)."""
    low = b.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.when(low >= F.lit(_INT31), low - F.lit(_INT32)).otherwise(low).cast("int")


def lenient_int(r: dict[str, Column], field: str) -> tuple[Column, Column]:
    """(value INT, error text) of a field that may be a number, a digit string or absent."""
    t, s, n, b = r["t"], r["s"], r["n"], r["b"]
    parsed = F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))
    value = (F.when(t == "STRING", parsed)
             .when(n & b.isNotNull() & (t != "DOUBLE"), _low32(b))
             .when(n, exact_low32(r["digits"])))   # beyond 64 bits, or not known exactly
    error = (F.when(~_present(t), F.lit(f"Null {INT_FIELDS[field]}"))
             .when((t == "STRING") & parsed.isNull(), F.concat(F.lit('For input string: "'), s, F.lit('"')))
             .when((t != "STRING") & ~n,
                   F.concat(F.lit("Unable to convert "), F.regexp_extract(t, r"^[A-Z]+", 0), F.lit(" to Integer"))))
    return value, error


def optional_string(r: dict[str, Column], field: str) -> tuple[Column, Column]:
    t = r["t"]
    value = F.when(t == "STRING", r["s"])
    error = F.when(_present(t) & (t != "STRING"), F.lit(f"{field} is not a string"))
    return value, error


def required_string(r: dict[str, Column], field: str) -> tuple[Column, Column]:
    t = r["t"]
    value = F.when(t == "STRING", r["s"])
    error = (F.when(~_present(t), F.lit(f"Missing required field '{field}'"))
             .when(t != "STRING", F.lit(f"{field} is not a string")))
    return value, error


def epoch_millis(r: dict[str, Column], field: str) -> tuple[Column, Column]:
    t, n, ms = r["t"], r["n"], r["b"]
    in_range = F.coalesce(ms.between(-MAX_EPOCH_MS, MAX_EPOCH_MS), F.lit(False))
    value = F.when(n & in_range, F.timestamp_millis(ms))
    error = (F.when(~_present(t), F.lit(NULL_TIMESTAMP))
             .when(~n, F.lit(f"{field} is not a number"))
             .when(~in_range, F.lit(f"{field} out of range")))
    return value, error


PROXY_FIELDS = {"process": "string", "destination_ip": "string", "source_ip": "string", "bytes_sent": "int",
                "bytes_received": "int", "destination_port": "int", "user": "string", "request_timestamp": "number"}


def proxy_request(df: DataFrame, text: str, out: str = "__") -> DataFrame:
    """The proxy-request converter: adds ``{out}ev_*`` event columns and ``{out}err`` (first error)."""
    staged, r = extract_fields(df, text, PROXY_FIELDS)
    process, e_process = optional_string(r["process"], "process")
    dst, e_dst = required_string(r["destination_ip"], "destination_ip")
    src, e_src = required_string(r["source_ip"], "source_ip")
    sent, e_sent = lenient_int(r["bytes_sent"], "bytes_sent")
    received, e_received = lenient_int(r["bytes_received"], "bytes_received")
    port, e_port = lenient_int(r["destination_port"], "destination_port")
    user, e_user = optional_string(r["user"], "user")
    ts, e_ts = epoch_millis(r["request_timestamp"], "request_timestamp")
    values = {"request_ts": ts, "src_ip": src, "dst_ip": dst, "dst_port": port, "process_name": process,
              "user_id": user, "bytes_sent": sent, "bytes_received": received}
    error = F.coalesce(e_process, e_dst, e_src, e_sent, e_received, e_port, e_user, e_ts)
    drop = [c for c in staged.columns if c.startswith(("__t_", "__s_", "__n_", "__b_"))] + ["__doc"]
    return staged.select("*", *[c.alias(f"{out}ev_{k}") for k, c in values.items()],
                         error.alias(f"{out}err")).drop(*drop)


def not_implemented(message: str) -> Callable[[DataFrame, str, str], DataFrame]:
    def converter(df: DataFrame, v: str, out: str) -> DataFrame:
        return df.withColumn(f"{out}err", F.lit(message))
    return converter


# Payload type → converter; any other type goes to the default (proxy request) converter.
# A converter adds ``{out}err`` and any ``{out}ev_<field>`` columns it fills.
CONVERTERS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {
    "type A": not_implemented(TYPE_A_MESSAGE),
}


def payload_type(attributes: Column) -> Column:
    return F.coalesce(attributes.getItem("payloadType"), F.lit(DEFAULT_PAYLOAD_TYPE))


def parse_messages(messages: DataFrame, converters: dict | None = None,
                   default: Callable[[DataFrame, str, str], DataFrame] | None = None,
                   keep: tuple[str, ...] = ("payload", "attributes")) -> DataFrame:
    """Every message once: event columns (null on failure) plus ``failure_reason``.

    Staged projections (Variant parse → field reads → values/errors → reason) keep every JSON
    lookup computed once per row.  Works on static and streaming frames; no shuffle, no Python.
    """
    conv = CONVERTERS if converters is None else converters
    v = "__text"
    staged = bind(messages, payload_text(F.col("payload")).alias(v), payload_type(F.col("attributes")).alias("__ptype"))
    staged = bind(staged, wrapped(F.col(v)).alias(f"{v}_array"))
    # A document is an object iff its text begins as one.
    staged = staged.select("*", only_document(F.col(f"{v}_array"), F.col(v)).isNotNull().alias("__json"),
                           F.ltrim(F.col(v), F.lit(JSON_SPACE)).startswith("{").alias("__obj"))
    converted = (default or proxy_request)(staged, v, "__")
    err = F.col("__err")
    ev = {c: F.col(f"__ev_{c}") for c in EVENT_FIELDS}
    for i, (name, fn) in enumerate(conv.items()):
        out = f"__c{i}_"
        converted = fn(converted, v, out)
        hit = F.col("__ptype") == name
        err = F.when(hit, F.col(f"{out}err")).otherwise(err)
        for c in EVENT_FIELDS:
            other = F.col(f"{out}ev_{c}") if f"{out}ev_{c}" in converted.columns else F.lit(None)
            ev[c] = F.when(hit, other).otherwise(ev[c])
    reason = (F.when(~F.col("__json"), F.lit(PARSE_PREFIX + PARSE_MESSAGE))
              .when(~F.col("__obj"), F.lit(INVALID_PREFIX + NOT_OBJECT))
              .when(err.isNotNull(), F.concat(F.lit(INVALID_PREFIX), err)))
    # Bound too: filters on outputs (valid split, user_id IS NOT NULL) must not inline the reason tree.
    with_reason = bind(converted, reason.alias("failure_reason")).drop(v)
    ok = F.col("failure_reason").isNull()
    extra = [c for c in messages.columns if c not in ("message_id", "publish_ts") and c not in keep]
    types = {f.name: f.dataType for f in event_struct_type().fields}
    return with_reason.select(
        *[F.when(ok, ev[c]).cast(types[c]).alias(c) for c in EVENT_FIELDS],
        "publish_ts", "message_id", "failure_reason",
        *[c for c in keep if c in messages.columns], *extra)


EVENT_FIELDS = ["request_ts", "src_ip", "dst_ip", "dst_port", "process_name", "user_id", "bytes_sent",
                "bytes_received"]


def event_struct_type():
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("request_ts", T.TimestampType()), T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()), T.StructField("dst_port", T.IntegerType()),
        T.StructField("process_name", T.StringType()), T.StructField("user_id", T.StringType()),
        T.StructField("bytes_sent", T.IntegerType()), T.StructField("bytes_received", T.IntegerType())])


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("failure_reason").isNull()).drop("failure_reason", "payload", "attributes")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("failure_reason").isNotNull()).select(
        "failure_reason", "payload", "message_id", "attributes", "publish_ts")
