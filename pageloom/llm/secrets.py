"""Secret scans: three patterns, and sliding-window entropy over candidate strings.

Everything is built from Spark's own functions.  A pattern's places come from splitting
the text at the pattern: the pieces and the matches alternate, so their lengths add up
to positions in code points.

**Entropy.**  Candidates are runs of 20 or more of ``A-Z a-z 0-9 + / _ = -``.  A
candidate belongs to the narrowest class that holds all its characters (``hex``,
``upper``, ``base64``), which gives its threshold.  A window of 20 characters slides over
it; the count of the character that enters goes up, that of the one that leaves goes
down, and the sum of ``c log2 c`` follows from the two counts alone (in whole 2^-16, so
that any engine gets the same number).  The span runs from the first window at or above
the threshold to the end of the last one.

**Allow list.**  Candidates are dropped that are one of: letters only; digits with
``+ / _ = -`` only; a UUID; words joined by ``- _ / +``, of letters or of digits; those
that hold ``example``, ``placeholder`` or ``xxxxxxxx`` in any case, or ``xxxx`` with at most
16 characters on either side (a long random run may hold four by chance).  The three patterns are
not subject to it.

Defined cases: a null text is an empty one, with no span; repeated rows give repeated
rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.text import unused

ASSIGN = (
    r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs of 16 and more are the long ones among all runs.
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "entropy")

#: The same, but a run that is too short is not tried again from each of its characters.
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Bits per character, by class.
THRESHOLDS = {"hex": 3.0, "upper": 3.4, "base64": 3.7}
ALPHABET = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
)
CLASSES = {"hex": "^(?:[0-9a-f]+|[0-9A-F]+)$", "upper": "^[A-Z0-9]+$"}
ALLOWED = (
    r"^[A-Za-z+/_=-]+$",
    r"^[0-9+/_=-]+$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^(?:[A-Za-z]+|[0-9]+)(?:[+/_-]+(?:[A-Za-z]+|[0-9]+))*$",
    r"(?:[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{8})",
    r"^.{0,16}[Xx]{4}.{0,16}$",
)
#: c * log2(c) in 2^-16 for counts up to the window.
C_LOG_C = [0] + [round(65536 * c * math.log2(c)) for c in range(1, WINDOW + 1)]
#: A window is at or above its class's threshold if its sum is at most this.
LIMITS = {k: int(65536 * WINDOW * (math.log2(WINDOW) - h)) for k, h in THRESHOLDS.items()}
#: Matches whose positions are added up in one step.
CHUNK = 256

REDACTED = "[REDACTED]"


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


_SPANS = "array<struct<start: bigint, end: bigint, value: string>>"


def with_places(df: DataFrame, body: str, out: str, pattern: str, value_group: int = 0) -> DataFrame:
    """``df`` with ``out``: ``array<struct<start, end, value>>`` of all matches.

    The text is searched once for the matches, and once more for the pieces between them
    if there are any.  Columns on the way are used twice each, so that Spark keeps them
    as columns and does not write them out at every use.
    """
    m, v, p = f"{out}__m", f"{out}__v", f"{out}__p"
    text = F.col(body)
    df = df.withColumn(m, _matches(text, pattern))
    some = F.size(m) > 0
    value = F.when(some, _matches(text, pattern, value_group)) if value_group else F.col(m)
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    parts = F.zip_with(
        F.slice(gaps, 1, F.size(m)),
        F.arrays_zip(F.col(m).alias("m"), value.alias("v")),
        lambda gap, x: F.struct(
            gap.alias("gap"), F.length(x["m"]).cast("long").alias("n"), x["v"].alias("v")
        ),
    )
    df = df.withColumn(p, F.when(some, parts))
    none, nothing = F.expr(f"CAST(array() AS {_SPANS})"), F.expr(f"CAST(array() AS array<{_SPANS}>)")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["n"]
        new = F.array(F.struct(start.alias("start"), end.alias("end"), x["v"].alias("value")))
        return F.struct(end.alias("at"), F.concat(state["out"], new).alias("out"))

    def chunk(state: Column, c: Column) -> Column:
        # a chunk's spans are collected apart, so that long lists are not copied per match
        done = F.aggregate(
            F.slice(p, c * CHUNK + 1, CHUNK), F.struct(state["at"].alias("at"), none.alias("out")), step
        )
        return F.struct(
            done["at"].alias("at"), F.concat(state["out"], F.array(done["out"])).alias("out")
        )

    chunks = F.sequence(F.lit(0), F.expr(f"(size(`{p}`) - 1) div {CHUNK}").cast("int"))
    added = F.aggregate(
        chunks, F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("out")), chunk
    )
    found = F.when(F.col(p).isNotNull(), F.flatten(added["out"])).otherwise(none)
    return df.withColumn(out, found).drop(m, v, p)


def allowed(value: Column) -> Column:
    """Whether the allow list holds a candidate."""
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | value.rlike(pattern)
    return out


def high_entropy(value: Column) -> Column:
    """``struct<first, last>``: where high-entropy windows of a candidate begin and end.

    Both are null if there is none.  All that does not change from one character to the
    next is part of the state, as a lambda's body is worked out at every step.
    """
    limit = (
        F.when(value.rlike(CLASSES["hex"]), LIMITS["hex"])
        .when(value.rlike(CLASSES["upper"]), LIMITS["upper"])
        .otherwise(LIMITS["base64"])
    )
    table = F.array(*[F.lit(x) for x in C_LOG_C])
    symbols = F.transform(
        F.array_remove(F.split(value, ""), ""),
        lambda ch: F.instr(F.lit(ALPHABET), ch) - 1,
    )
    # each character with the one that leaves the window as it enters
    before = F.slice(F.concat(F.array_repeat(F.lit(-1), WINDOW), symbols), 1, F.size(symbols))
    entering = F.zip_with(
        symbols, before, lambda x, old: F.struct(x.alias("new"), old.alias("old"))
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).alias("sum"),
        F.lit(0).alias("i"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
        limit.alias("limit"),
        table.alias("table"),
    )

    def step(s: Column, x: Column) -> Column:
        up = F.get(s["counts"], x["new"])
        more = s["sum"] + F.get(s["table"], up + 1) - F.get(s["table"], up)
        down = F.get(s["counts"], F.greatest(x["old"], F.lit(0))) + (
            x["old"] == x["new"]
        ).cast("int")
        total = F.when(
            x["old"] >= 0, more + F.get(s["table"], down - 1) - F.get(s["table"], down)
        ).otherwise(more)
        counts = F.transform(
            s["counts"],
            lambda n, j: n + (j == x["new"]).cast("int") - (j == x["old"]).cast("int"),
        )
        high = (s["i"] >= WINDOW - 1) & (total <= s["limit"])
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            (s["i"] + 1).alias("i"),
            F.when(s["first"].isNull() & high, s["i"] - (WINDOW - 1)).otherwise(s["first"]).alias("first"),
            F.when(high, s["i"] + 1).otherwise(s["last"]).alias("last"),
            s["limit"].alias("limit"),
            s["table"].alias("table"),
        )

    done = F.aggregate(
        entering, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"))
    )
    return done


def _of_kind(rank: int, found: Column, keep=None) -> Column:
    kept = F.filter(found, keep) if keep else found
    return F.transform(
        kept,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(rank).alias("kind"), x["end"].alias("end")
        ),
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def find_secrets(docs: DataFrame, out: str, *, text: str = "text", whole: bool = False) -> DataFrame:
    """``docs`` with a struct column ``out``: one array of spans per kind.

    ``assign``, ``access``, ``hex`` and ``entropy`` are arrays of
    ``struct<start, kind, end>``; ``kind`` counts in that order from 0.  With ``whole``
    the spans are what must not stay: of an assignment the value, of a candidate all of it.
    """
    t = unused(docs, f"{out}__", prefix=True)
    found = docs.withColumn(f"{t}t", F.coalesce(F.col(text), F.lit("")))
    for name, pattern, group in (
        ("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("entropy", RUN, 0)
    ):
        found = with_places(found, f"{t}t", f"{t}{name}", pattern, group)
    assigned = F.col(f"{t}assign")
    if whole:
        assigned = F.transform(
            assigned,
            lambda x: F.struct((x["end"] - F.length(x["value"])).alias("start"), x["end"].alias("end"), x["value"].alias("value")),
        )
    assign = _of_kind(0, assigned, lambda x: F.length(x["value"]) >= 12)
    access = _of_kind(1, F.col(f"{t}access"), lambda x: x["end"] - x["start"] >= 18)
    hexes = _of_kind(2, F.col(f"{t}hex"))
    high = F.transform(
        F.filter(f"{t}entropy", lambda x: ~allowed(x["value"])),
        lambda x: F.struct(
            x["start"].alias("at"), x["end"].alias("end"), high_entropy(x["value"]).alias("w")
        ),
    )
    entropy = F.transform(
        F.filter(high, lambda x: x["w"]["first"].isNotNull()),
        lambda x: F.struct(
            (x["at"] if whole else x["at"] + x["w"]["first"]).alias("start"),
            F.lit(3).alias("kind"),
            (x["end"] if whole else x["at"] + x["w"]["last"]).alias("end"),
        ),
    )
    return found.withColumn(
        out,
        F.struct(
            assign.alias("assign"), access.alias("access"), hexes.alias("hex"), entropy.alias("entropy")
        ),
    ).drop(*[f"{t}{n}" for n in ("t", "assign", "access", "hex", "entropy")])


def _without(body: Column, spans: Column) -> Column:
    """``body`` with the union of ``spans`` (sorted) replaced.

    The spans are taken in chunks, each with the part of the text that it covers, so that
    a long text with many of them is not gone through for each.
    """

    def step(s: Column, x: Column) -> Column:
        after = F.greatest(s["at"], F.lit(0).cast("long"))
        gap = F.substr(s["part"], (after - s["base"] + 1).cast("int"), (x["start"] - after).cast("int"))
        new = F.when(x["start"] > s["at"], F.concat(gap, F.lit(REDACTED))).otherwise("")
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.concat(s["out"], new).alias("out"),
            s["base"].alias("base"),
            s["part"].alias("part"),
        )

    def chunk(s: Column, c: Column) -> Column:
        some = F.slice(spans, c * CHUNK + 1, CHUNK)
        base = F.greatest(s["at"], F.lit(0).cast("long"))
        far = F.greatest(F.element_at(some, -1)["start"] - base, F.lit(0).cast("long"))
        part = F.substr(body, (base + 1).cast("int"), far.cast("int"))
        start = F.struct(
            s["at"].alias("at"), F.lit("").alias("out"), base.alias("base"), part.alias("part")
        )
        done = F.aggregate(
            some, start, step, lambda d: F.struct(d["at"].alias("at"), F.array(d["out"]).alias("out"))
        )
        return F.get(
            F.transform(
                F.array(done),
                lambda d: F.struct(d["at"].alias("at"), F.concat(s["out"], d["out"]).alias("out")),
            ),
            0,
        )

    chunks = F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / CHUNK).cast("int"))
    # a span at the very start is after the end of none
    start = F.struct(F.lit(-1).cast("long").alias("at"), F.expr("CAST(array() AS array<string>)").alias("out"))
    return F.aggregate(
        chunks,
        start,
        chunk,
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substr(body, (s["at"] + 1).cast("int"), F.length(body))
        ),
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with secrets replaced in ``text`` (null stays null).

    All that ``find_secrets`` reports goes: of an assignment only the value, of a candidate
    the whole candidate; spans that meet become one.  What is left of a text that held
    secrets is then searched again, one kind after another, as a remainder can be one.
    Each kind is a column of its own, so that no text is searched over and over.
    """
    last = F.array(F.lit(""))
    columns, own = docs.columns, unused(docs, "__redact", prefix=True)
    name, s, spans = f"{own}ed", f"{own}_s", f"{own}_spans"
    docs = find_secrets(docs, s, text=text, whole=True)
    docs = docs.withColumn(
        spans, F.array_sort(F.concat(f"{s}.assign", f"{s}.access", f"{s}.hex", f"{s}.entropy"))
    ).drop(s)
    held = F.size(spans) > 0
    body = F.col(f"`{text}`")
    docs = docs.withColumn(name, F.when(held, _without(body, F.col(spans))).otherwise(body))

    def value_of(m: Column, h: Column) -> Column:
        long = F.length(m) - F.length(h) >= 12
        return F.when(long, F.concat(h, F.lit(REDACTED))).otherwise(m)

    def if_(test):
        return lambda body, pattern: F.transform(
            _matches(body, pattern), lambda m: F.when(test(m), F.lit(REDACTED)).otherwise(m)
        )

    steps = (
        (ASSIGN, lambda body, p: F.zip_with(_matches(body, p), _matches(body, p, 1), value_of)),
        (ACCESS, if_(lambda m: F.length(m) >= 18)),
        (HEX, if_(lambda m: F.length(m) >= 16)),
        (RUN, if_(lambda m: ~allowed(m) & high_entropy(m)["first"].isNotNull())),
    )
    for i, (pattern, new) in enumerate(steps):
        body = F.col(f"`{name}`")
        pieces = F.zip_with(
            F.split(body, pattern, -1),
            F.concat(new(body, pattern), last),
            lambda p, m: F.concat(p, m),
        )
        name = f"{own}ed{i}"
        docs = docs.withColumn(
            name, F.when(held & body.rlike(pattern), F.array_join(pieces, "")).otherwise(body)
        )
    return docs.select(
        *[F.col(name).alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op8: secrets of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs, "s")
    base = F.array_sort(F.concat("s.assign", "s.access", "s.hex"))
    every = F.array_sort(F.concat("s.assign", "s.access", "s.hex", "s.entropy"))
    return found.select(
        "doc_id",
        F.size("s.assign").cast("long").alias("n_assign"),
        F.size("s.access").cast("long").alias("n_access"),
        F.size("s.hex").cast("long").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )


def _sql_places(name: str, pattern: str, keep: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
{name}_m AS (
  SELECT doc_id, r, t, regexp_extract_all(t, '{p}') AS m,
         string_split_regex(t, '{p}') AS gaps FROM d),
{name} AS (
  SELECT doc_id, r, m[i] AS v,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
              + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM {name}_m)
  WHERE {keep})"""


_SQL_ALLOWED = " OR ".join(f"regexp_matches(v, '{p}')" for p in ALLOWED)
_SQL_TABLE = "[" + ", ".join(map(str, C_LOG_C)) + "]"
_SQL_VALUE = """len(regexp_replace(m[i], '^(?:[A-Za-z]|_)+["'']? *[:=] *["'']?', ''))"""

ORACLE = (
    "WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),"
    + _sql_places("assign", ASSIGN, f"{_SQL_VALUE} >= 12")
    + ","
    + _sql_places("access", ACCESS, "length(m[i]) >= 18")
    + ","
    + _sql_places("hexes", HEX, "true")
    + ","
    + _sql_places("cand", CANDIDATE, "true")
    + f""",
runs AS (
  SELECT doc_id, r, a, v,
         CASE WHEN regexp_matches(v, '{CLASSES["hex"]}') THEN {LIMITS["hex"]}
              WHEN regexp_matches(v, '{CLASSES["upper"]}') THEN {LIMITS["upper"]}
              ELSE {LIMITS["base64"]} END AS most
  FROM cand WHERE NOT ({_SQL_ALLOWED})),
wins AS (
  SELECT *, list_sum(list_transform(list_distinct(string_split(w, '')),
             lambda c: ({_SQL_TABLE})[length(w) - length(replace(w, c, '')) + 1])) AS s
  FROM (SELECT *, substr(v, i, {WINDOW}) AS w
        FROM (SELECT *, unnest(generate_series(1, length(v) - {WINDOW - 1})) AS i FROM runs))),
entropy AS (
  SELECT doc_id, r, a + min(i) - 1 AS a, a + max(i) + {WINDOW - 1} AS b
  FROM wins WHERE s <= most GROUP BY doc_id, r, a),
spans AS (
  SELECT r, 0 AS k, 'assign' AS kind, a, a + length(v) AS b FROM assign
  UNION ALL SELECT r, 1, 'access', a, a + length(v) FROM access
  UNION ALL SELECT r, 2, 'hex', a, a + length(v) FROM hexes
  UNION ALL SELECT r, 3, 'entropy', a, b FROM entropy),
agg AS (
  SELECT r, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1,
         count(*) FILTER (k = 2) AS n2,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k, b) FILTER (k < 3) AS base,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, k, b) AS every
  FROM spans GROUP BY r)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign,
       CAST(coalesce(n1, 0) AS BIGINT) AS n_access, CAST(coalesce(n2, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM d LEFT JOIN agg USING (r)
"""
)
