"""Secret scan with corpus-wide ownership frequency.

Three base patterns give spans per document. The secret of each span, and every other long
mixed-case token with digits, is a candidate. Candidate hashes are counted over the corpus: in how
many documents (repositories) and for how many owners they occur. A candidate of several owners
is an example people copy; one that stays with a single owner looks live. Where ``by_docs`` is asked, documents weigh as well: one in
very many documents is an example also with a single owner, one of two owners in a few documents still
looks live. Tokens that look
live become spans of kind ``owned`` beside the base spans; base spans always stay and carry their
verdict.

The query weighs both as well. Its candidates are those its SQL states. Masking takes whole runs of the base64 letters instead, so that
no key is left in part and keys without a capital or a digit are found.

Positions come from the pieces between matches, so that each pattern is run on a whole text by
Java's own matcher and never row by row in Python.

Defined cases: null text is the empty text; a null owner counts as one owner; repeated rows count
as documents of their own; an empty table gives no rows. Result columns win over columns of
the documents of the same name; the others are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyground.functions.variant import with_computed
from skyground.llm.common import boxed, others, staged, unboxed

# The three patterns and the least lengths. Letters of the first are spelt in both cases.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
# Leftmost runs of 32 or more are the runs of any length less the short ones.
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex")

# The method's own kind: long tokens with capital, small letter and digit.
TOKEN = r"[A-Za-z0-9_-]{24,}"
MAX_OWNERS = 1
# With documents counted as well: so many make an example whatever the owners, and up to so few of one owner
# more than MAX_OWNERS do not.
MANY_DOCS = 1000
FEW_DOCS = 4

# What masking goes by: whole runs of the base64 letters and '.', with padding only where the run ends. A run is
# a candidate if it holds a TOKEN of all three classes, or if what is left of it without words and numbers (camel case
# is words) is long enough, so that keys without a digit or a capital count and paths and hyphenated words do not.
RUN = r"[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{22,}[A-Za-z0-9+/_-](?:={1,2}(?![A-Za-z0-9+/_=-]))?"
MIXED_TOKEN = (
    r"(?<![A-Za-z0-9_-])(?=[a-z0-9_-]*[A-Z])(?=[A-Z0-9_-]*[a-z])(?=[A-Za-z_-]*[0-9])" + TOKEN
)
# Possessive, so that Java matches long ones without recursion.
WORDS = r"(?<![A-Za-z0-9])(?:[A-Z]?[a-z]*+(?:[A-Z][a-z]{2,}+)*+|[A-Z]++|[0-9]++)(?![A-Za-z0-9])|[+/_.=-]"
MIN_OPAQUE = 16

# Running sums are taken in blocks, so that no step copies all that was made before it.
BLOCK = 64
# Texts are cut where spans may stand by blocks of 2 ** 12 code points.
BLOCK_BITS = 12

ITEM = "array<struct<gap:int,size:int,secret:string>>"
SPAN = "array<struct<kind:string,start:int,end:int,secret:string>>"
JUDGED = "array<struct<kind:string,start:int,end:int,secret:string,live:boolean,n_docs:bigint,n_owners:bigint>>"
RESULTS = (
    *("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_owned", "n_live", "n_example"),
    *("n_docs", "n_owners"),
)


def _items(text: Column, matches: Column, pattern: str, secrets: Column) -> Column:
    """Per match the length of the piece before it, its own, and its secret."""
    pieces = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    zipped = F.zip_with(
        pieces,
        F.arrays_zip(matches.alias("m"), secrets.alias("s")),
        lambda piece, pair: F.struct(
            F.length(piece).alias("gap"), F.length(pair["m"]).alias("size"), pair["s"].alias("secret")
        ),
    )
    return F.when(F.size(matches) > 0, zipped).otherwise(F.array().cast(ITEM))


def _before(df: DataFrame, name: str, values: dict[str, Column], merge) -> DataFrame:
    """``df`` with a struct ``name``: for each array of integers, what ``merge`` makes of 0 and all entries before each.

    Blocks are merged first, then the entries within each block, so the time is linear but for a :data:`BLOCK`-th.
    """

    def blocks(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        cut = F.transform(numbers, lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(v) > 0, cut).otherwise(F.array().cast("array<array<int>>"))

    def over(b: Column) -> Column:
        totals = F.transform(b, lambda x: F.aggregate(x, F.lit(0), merge))
        return F.aggregate(
            totals, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(merge(F.element_at(acc, -1), x)))
        )

    def each(b: Column, o: Column) -> Column:
        within = lambda x, first: F.transform(
            x, lambda _, i: F.aggregate(F.slice(x, F.lit(1), i), first, merge)
        )
        return F.flatten(F.zip_with(b, F.slice(o, F.lit(1), F.size(b)), within))

    struct = lambda make: F.struct(*[make(k).alias(k) for k in values])
    # Lambdas look these up again and again, so each is computed once per row.
    df = with_computed(df, "_values", struct(lambda k: values[k]))
    df = with_computed(df, "_blocked", struct(lambda k: blocks(F.col(f"_values.{k}"))))
    df = with_computed(df, "_over", struct(lambda k: over(F.col(f"_blocked.{k}"))))
    df = with_computed(df, name, struct(lambda k: each(F.col(f"_blocked.{k}"), F.col(f"_over.{k}"))))
    return df.drop("_values", "_blocked", "_over")


def _spans(kind: str, keep) -> Column:
    """Spans of a kind's matches; a match starts where the pieces and matches before it end."""
    spans = F.zip_with(
        f"_items.{kind}",
        f"_ends.{kind}",
        lambda x, at: F.struct(
            F.lit(kind).alias("kind"),
            (at + x["gap"]).alias("start"),
            (at + x["gap"] + x["size"]).alias("end"),
            x["secret"].alias("secret"),
        ),
    )
    return F.filter(spans, keep)


def _all(pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))


def find(docs: DataFrame, runs: bool = False) -> DataFrame:
    """``docs`` with ``_base`` (ordered spans of the three patterns) and ``_tokens`` (tokens, within base spans too).

    ``runs``: candidates are whole :data:`RUN`, not the :data:`TOKEN` of three classes that the SQL states.
    """
    token = RUN if runs else TOKEN
    none = F.array().cast("array<string>")
    matched = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumns(
        {"_m0": _all(ASSIGN), "_m1": _all(ACCESS), "_m2": _all(HEX), "_m3": _all(token)}
    )
    keyed = matched.withColumn("_g", F.when(F.size("_m0") > 0, _all(ASSIGN, 2)).otherwise(none))
    mixed = lambda x: (
        x["secret"].rlike("[A-Z]") & x["secret"].rlike("[a-z]") & x["secret"].rlike("[0-9]")
    )
    opaque = lambda x: (
        x["secret"].rlike(MIXED_TOKEN) | (F.length(F.regexp_replace(x["secret"], WORDS, "")) >= MIN_OPAQUE)
    )
    text = F.col("_text")
    m0, m1, m2, m3 = (F.col(f"_m{i}") for i in range(4))
    items = with_computed(
        keyed,
        "_items",
        F.struct(
            _items(text, m0, ASSIGN, F.col("_g")).alias("assign"),
            _items(text, m1, ACCESS, m1).alias("access"),
            _items(text, m2, HEX, m2).alias("hex"),
            _items(text, m3, token, m3).alias("owned"),
        ),
    )
    lengths = {k: F.transform(f"_items.{k}", lambda x: x["gap"] + x["size"]) for k in (*KINDS, "owned")}
    size = lambda x: x["end"] - x["start"]
    found = {
        "assign": _spans("assign", lambda x: F.length(x["secret"]) >= MIN_ASSIGN),
        "access": _spans("access", lambda x: size(x) >= MIN_ACCESS),
        "hex": _spans("hex", lambda x: size(x) >= MIN_HEX),
    }
    return _before(items, "_ends", lengths, lambda a, x: a + x).select(
        *docs.columns,
        _ordered(F.concat(*found.values())).alias("_base"),
        _spans("owned", opaque if runs else mixed).alias("_tokens"),
    )


def _ordered(spans: Column) -> Column:
    """By start, then in the order of kinds."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate((*KINDS, "owned")) for x in (k, i)])
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("a"), rank[s["kind"]].alias("b"), s.alias("s"))
    )
    return F.transform(F.sort_array(keyed), lambda x: x["s"])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def ownership(candidates: DataFrame, max_owners: int = MAX_OWNERS, by_docs: bool = False) -> DataFrame:
    """``_hash, n_docs, n_owners, live`` of each candidate (``_hash, _owner``, one row per document and hash).

    ``by_docs``: the documents decide together with the owners.
    """
    live = F.col("n_owners") <= max_owners
    if by_docs:
        passed_on = (F.col("n_owners") <= max_owners + 1) & (F.col("n_docs") <= FEW_DOCS)
        live = (live | passed_on) & (F.col("n_docs") < MANY_DOCS)
    per_owner = candidates.groupBy("_hash", "_owner").agg(F.count("*").alias("docs"))
    return (
        per_owner.groupBy("_hash")
        .agg(F.sum("docs").alias("n_docs"), F.count("*").alias("n_owners"))
        .withColumn("live", live)
    )


def _found(docs: DataFrame, owner: str, columns: list[str], runs: bool = False) -> DataFrame:
    """``columns`` of ``docs`` boxed, with a row number, the owner, ``_base`` and ``_tokens``; written once."""
    found = find(docs.select("text", F.coalesce(F.col(owner), F.lit("")).alias("_owner"), boxed(columns)), runs)
    return staged(
        found.select("_box", F.monotonically_increasing_id().alias("_row"), "_owner", "_base", "_tokens"), "spans"
    )


def _candidates(rows: DataFrame) -> DataFrame:
    """``_row, _owner, s`` of all spans and tokens; tokens that touch a base span are that span's business."""
    spans = rows.filter(F.size("_base") + F.size("_tokens") > 0).select(
        "_row", "_owner", F.explode(F.concat("_base", "_tokens")).alias("s")
    )
    token, start, end = F.col("s.kind") == "owned", F.col("s.start"), F.col("s.end")
    # A window holds the spans of one document; frames end at the row and its peers.
    up, down = (Window.partitionBy("_row").orderBy(o) for o in (F.col("s.start"), F.col("s.start").desc()))
    behind = F.max(F.when(~token, end)).over(up)
    ahead = F.min(F.when(~token, start)).over(down)
    touched = F.coalesce(behind > start, F.lit(False)) | F.coalesce(ahead < end, F.lit(False))
    return spans.withColumn("_touched", touched).filter(~token | ~F.col("_touched")).drop("_touched")


def _judged(rows: DataFrame, max_owners: int, by_docs: bool = False) -> DataFrame:
    """``_row, _judged``: all spans and candidates of each row that has some, each with ``live`` and its counts."""
    candidates = staged(_candidates(rows).withColumn("_hash", F.sha2("s.secret", 256)), "candidates")
    # A document names a secret once.
    verdicts = staged(
        ownership(candidates.select("_row", "_hash", "_owner").distinct(), max_owners, by_docs), "ownership"
    )
    # Both sides are plain shuffles, so adaptive execution splits a secret that a third of the rows hold.
    return (
        candidates.join(verdicts.hint("merge"), "_hash")
        .groupBy("_row")
        .agg(
            F.collect_list(
                F.struct("s.kind", "s.start", "s.end", "s.secret", "live", "n_docs", "n_owners")
            ).alias("_judged")
        )
    )


def _pick(condition) -> Column:
    """Judged spans for which ``condition`` holds; none where nothing was judged."""
    return F.coalesce(F.filter("_judged", condition), F.array().cast(JUDGED))


def scan(
    docs: DataFrame, owner: str = "source", max_owners: int = MAX_OWNERS, by_docs: bool = False
) -> DataFrame:
    """Every row of ``docs`` without its text, with :data:`RESULTS`; ``by_docs`` as in :func:`ownership`.

    ``n_docs`` and ``n_owners`` are the most documents and owners any secret or candidate of the row has, 0 without one.
    """
    carried = others(docs, RESULTS, "text")
    rows = _found(docs, owner, carried)
    kind_count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")
    number = lambda condition: F.size(_pick(condition)).cast("long")
    most = lambda count: F.coalesce(F.array_max(F.transform("_judged", lambda s: s[count])), F.lit(0))
    return rows.join(_judged(rows, max_owners, by_docs).hint("merge"), "_row", "left").select(
        *unboxed(carried),
        *[kind_count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(F.col("_base")).cast("binary"), 256).alias("base_sha256"),
        _joined(_ordered(_pick(lambda s: (s["kind"] != "owned") | s["live"]))).alias("spans"),
        number(lambda s: (s["kind"] == "owned") & s["live"]).alias("n_owned"),
        number(lambda s: (s["kind"] != "owned") & s["live"]).alias("n_live"),
        number(lambda s: (s["kind"] != "owned") & ~s["live"]).alias("n_example"),
        *[most(count).cast("long").alias(count) for count in ("n_docs", "n_owners")],
    )


def _between(blocks: Column, a: Column, b: Column) -> Column:
    """Code points ``a`` to ``b`` of a text cut into blocks of 2 ** :data:`BLOCK_BITS`, without a walk from its start."""
    i, j = F.shiftright(a, BLOCK_BITS), F.shiftright(b, BLOCK_BITS)
    mask = F.lit((1 << BLOCK_BITS) - 1)
    block = lambda n: F.coalesce(F.get(blocks, n), F.lit(""))
    head = a.bitwiseAND(mask) + 1
    whole = F.concat(
        F.substr(block(i), head),
        F.array_join(F.slice(blocks, i + 2, j - i - 1), ""),
        F.substr(block(j), F.lit(1), b.bitwiseAND(mask)),
    )
    return F.when(i == j, F.substr(block(i), head, b - a)).otherwise(whole)


def redact(
    docs: DataFrame,
    owner: str = "source",
    max_owners: int = MAX_OWNERS,
    mark: str = "[secret]",
    by_docs: bool = False,
) -> DataFrame:
    """``docs`` with ``mark`` in place of every span that looks live; spans that overlap give one mark.

    Candidates are whole runs (:data:`RUN`); ``by_docs`` as in :func:`ownership`. Rows without candidates do not move.
    """
    rows = _found(docs, owner, docs.columns, runs=True)
    text = F.coalesce("_box.text", F.lit(""))
    some = F.size("_base") + F.size("_tokens") > 0
    judged = rows.filter(some).join(_judged(rows, max_owners, by_docs).hint("merge"), "_row", "left")
    cut = with_computed(
        judged, "_blocks", F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << BLOCK_BITS}}}"), F.lit(0))
    )
    live = with_computed(cut, "_live", _ordered(_pick(lambda s: s["live"])))
    ends = F.transform("_live", lambda s: s["end"])
    reached = _before(live, "_reach", {"ends": ends}, lambda a, x: F.greatest(a, x))
    blocks = F.col("_blocks")
    pieces = F.zip_with(
        "_live",
        "_reach.ends",
        lambda s, at: F.when(
            s["start"] >= at, F.concat(_between(blocks, at, s["start"]), F.lit(mark))
        ).otherwise(""),
    )
    masked = F.when(F.size("_live") == 0, F.col("_box.text")).otherwise(
        F.concat(F.array_join(pieces, ""), _between(blocks, F.array_max(ends), F.length(text)))
    )
    columns = [masked.alias(c) if c.lower() == "text" else unboxed([c])[0] for c in docs.columns]
    return rows.filter(~some).select(*unboxed(docs.columns)).union(reached.select(*columns))
