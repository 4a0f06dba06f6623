"""Chat formatting (8) in budgeted windows, in DataFrame functions only.

A conversation's turns, in order, get prefix sums of their token estimates. The prefix sum at which a
turn starts decides its window, so windows are spans of whole turns. Every later window repeats the
system turn, then as many of the previous window's last turns as fit the history budget, and then its
new turns. Only assistant texts among the new turns carry loss, so that each is trained on once.

Template: ``<|role|>⏎text<|end|>⏎``. In texts ``&``, ``<`` and ``[`` are written as character references, so no
control string of this or a bracketed template survives inside a text, and reading back is exact. Roles also
have ``|`` and line ends written so.

One shuffle by conversation serves all steps. Windows hold at most the budget unless one turn alone is longer
than half a window; running sums and lags stream over a conversation of any length.

Defined results: a null text or role is empty; a null turn comes first; turns with one number follow role, then
text; repeated rows are turns of their own; rows with a null conversation form one; a conversation of only a system
turn is one window without loss; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Tokens of a window, and of them for repeated history.
BUDGET, HISTORY = 1024, 256
#: Token estimate of a turn: its characters divided by this, rounded up, and a few for the markers.
CHARS_PER_TOKEN, TURN_TOKENS = 4, 4
# Characters written as references, in the order they are replaced.
TEXT_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;")]
ROLE_ESCAPES = [*TEXT_ESCAPES, ("|", "&#124;"), ("\n", "&#10;")]
_END = "<|end|>\n"


def escape(c: Column, pairs: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    for raw, safe in pairs:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column, pairs: list[tuple[str, str]] = TEXT_ESCAPES) -> Column:
    for raw, safe in reversed(pairs):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def head(role: Column) -> Column:
    return F.concat(F.lit("<|"), escape(role, ROLE_ESCAPES), F.lit("|>\n"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, turns): array of (n, start, role, text, fresh) per window; repeated turns are not fresh."""
    if not 0 <= history < budget:
        raise ValueError("the history budget must be smaller than the budget")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("tokens", F.ceil(F.length("text") / CHARS_PER_TOKEN).cast("long") + TURN_TOKENS).withColumn("n", F.row_number().over(order))
    first_system = F.when((F.col("n") == 1) & (F.col("role") == "system"), F.struct("role", "text", "tokens"))
    rows = rows.withColumn("system", F.first(first_system).over(so_far))
    system_tokens = F.coalesce(F.col("system.tokens"), F.lit(0).cast("long"))
    is_system = (F.col("n") == 1) & F.col("system").isNotNull()
    rows = rows.withColumn("own", F.when(is_system, F.lit(0).cast("long")).otherwise(F.col("tokens")))
    rows = rows.withColumn("start", F.sum("own").over(so_far) - F.col("own"))
    # Half of what system turn and history leave: a turn that starts in a window may end beyond its bound.
    span = F.greatest(F.floor((F.lit(budget - history) - system_tokens) / 2), F.lit(1).cast("long"))
    rows = rows.withColumn("bucket", F.floor(F.col("start") / span))
    made = rows.groupBy("conv_id", "bucket").agg(
        F.sort_array(F.collect_list(F.struct("n", "start", "role", "text"))).alias("fresh"), F.min("start").alias("first"), F.any_value("system").alias("system"))
    by_bucket = Window.partitionBy("conv_id").orderBy("bucket")
    made = made.withColumn("before", F.lag("fresh").over(by_bucket)).withColumn("window", F.row_number().over(by_bucket))
    turn = lambda t, fresh: F.struct(t["n"].alias("n"), t["role"].alias("role"), t["text"].alias("text"), F.lit(fresh).alias("fresh"))
    none = F.array().cast("array<struct<n:int,role:string,text:string,fresh:boolean>>")
    system = F.when((F.col("window") > 1) & F.col("system").isNotNull(), F.array(
        F.struct(F.lit(1).alias("n"), F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.lit(False).alias("fresh")))).otherwise(none)
    past = F.filter(F.coalesce("before", F.array().cast("array<struct<n:int,start:bigint,role:string,text:string>>")),
                    lambda t: (F.col("first") - t["start"] <= history) & ((t["n"] > 1) | F.col("system").isNull()))
    return made.select("conv_id", "window", F.concat(system, F.transform(past, lambda t: turn(t, False)), F.transform("fresh", lambda t: turn(t, True))).alias("turns"))


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, n_repeated, loss): ``loss`` spans (start, end) of ``formatted`` in code points, end exclusive."""
    made = windows(turns, budget, history)
    parts = F.transform("turns", lambda t: F.struct(head(t["role"]).alias("head"), escape(t["text"]).alias("body"),
                                                    (t["fresh"] & (t["role"] == "assistant")).alias("target")))
    made = made.withColumn("parts", parts)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(_END)).alias("at"), F.when(p["target"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return made.select("conv_id", "window", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(_END))), "").alias("formatted"),
                       F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("n_repeated"), F.aggregate("parts", state, step)["spans"].alias("loss"))


def read_turns(formatted: Column) -> Column:
    """array of (role, text) read back from a formatted window."""
    parts = F.split(formatted, r"<\|end\|>\n")
    opening = lambda p: F.substring_index(p, "|>\n", 1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(
        unescape(F.substring(opening(p), F.lit(3), F.length(p)), ROLE_ESCAPES).alias("role"),
        unescape(F.substring(p, F.length(opening(p)) + 4, F.length(p))).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))


#: A conversation whose texts look like another template's control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def chat_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted windows; the probe conversation is added."""
    row = lambda c, t, r, x: F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text"))
    probe = conversations.sparkSession.range(1).select(F.inline(F.array(*[row(*p) for p in PROBE])))
    rows = format_conversations(conversations.select("conv_id", "turn", "role", "text").unionByName(probe))
    read = rows.select("conv_id", "window", F.length("formatted").alias("n"),
                       F.filter(read_turns(F.col("formatted")), lambda _, i: i >= F.col("n_repeated")).alias("turns"),
                       read_loss(F.col("formatted"), F.col("loss")).alias("loss"))
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"), F.sum("n").alias("formatted_chars"))
    turns, loss = F.flatten("w.turns"), F.array_join(F.flatten("w.loss"), "")
    text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.col("formatted_chars").cast("long"))


def oracle() -> str:
    """The digests straight from the turns; the windows only for the formatted length."""
    def refs(column: str, pairs: list[tuple[str, str]]) -> str:
        for raw, safe in pairs:
            column = f"replace({column}, {'chr(10)' if raw == chr(10) else repr(raw)}, '{safe}')"
        return column

    probe = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in PROBE)
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM
 (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {probe}) v(conv_id, turn, role, text))),
a AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
 (length(text) + {CHARS_PER_TOKEN - 1}) // {CHARS_PER_TOKEN} + {TURN_TOKENS} AS tokens,
 length({refs('role', ROLE_ESCAPES)}) + length({refs('text', TEXT_ESCAPES)}) + {5 + len(_END)} AS chars FROM t),
s AS (SELECT conv_id, tokens AS system_tokens, chars AS system_chars FROM a WHERE n = 1 AND role = 'system'),
b AS (SELECT a.*, system_chars, CASE WHEN n = 1 AND system_tokens IS NOT NULL THEN 0 ELSE tokens END AS own,
 greatest(({BUDGET - HISTORY} - coalesce(system_tokens, 0)) // 2, 1) AS span FROM a LEFT JOIN s ON a.conv_id IS NOT DISTINCT FROM s.conv_id),
c AS (SELECT *, sum(own) OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) - own AS start FROM b),
d AS (SELECT *, (start // span)::BIGINT AS bucket FROM c),
w AS (SELECT conv_id, bucket, min(start) AS first, any_value(system_chars) AS system_chars, lag(bucket) OVER (PARTITION BY conv_id ORDER BY bucket) AS before FROM d GROUP BY conv_id, bucket),
h AS (SELECT w.conv_id, sum(d.chars) AS chars FROM w JOIN d ON w.conv_id IS NOT DISTINCT FROM d.conv_id AND d.bucket = w.before
 AND w.first - d.start <= {HISTORY} AND (d.n > 1 OR d.system_chars IS NULL) GROUP BY w.conv_id),
r AS (SELECT conv_id, sum(system_chars) AS chars FROM w WHERE before IS NOT NULL GROUP BY conv_id),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars) AS chars FROM d GROUP BY conv_id)
SELECT g.conv_id, g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256, (g.chars + coalesce(h.chars, 0) + coalesce(r.chars, 0))::BIGINT AS formatted_chars
FROM g LEFT JOIN h ON g.conv_id IS NOT DISTINCT FROM h.conv_id LEFT JOIN r ON g.conv_id IS NOT DISTINCT FROM r.conv_id"""
