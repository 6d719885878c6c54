"""Line dedup: exact copies by hash, near copies by a segment-partition edit join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.session import WorkTables, materialize

#: Characters that a line needs to be compared with others, and edits between near copies:
#: one for each CHARS_AN_EDIT characters of the shorter line, at least one, MAX_EDITS at most.
LEAST_CHARS = 20
CHARS_AN_EDIT = 30
MAX_EDITS = 3
#: Keys with more index rows than this, so many possible pairs for each of their rows, are split by
#: their lines' remainders if their pairs outnumber all rows and their index rows the keys of a
#: line, so many times at most. A pair costs a comparison of bits, a split makes many rows of one.
HOT_PAIRS = 512
SPLITS = 4
#: Bits that spare lines without candidates a shuffle (fixed size: 1 MB).
SLOTS = 1 << 23

KEEP, EXACT, NEAR = 0, 1, 2


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(delta, part, shift) of all index and probe keys of a text.

    A text of length n is cut into edits + 1 even segments; a text within the edits of another
    holds one of that one's segments. A text probes the lengths n - edits to n, each segment
    only at the positions that leave enough edits for the parts left and right of it. Probes
    without delta and shift equal the index key and are not repeated.
    """
    out = []
    for delta in range(edits + 1):
        for part in range(edits + 1):
            low = max(-part, delta - (edits - part))
            high = min(part, delta + (edits - part))
            out += [(delta, part, shift) for shift in range(low, high + 1)]
    return out


def edits_of(chars: Column, edits: int) -> Column:
    """Edits that two lines may be apart, the shorter of so many characters."""
    return F.greatest(F.lit(1), F.least(F.lit(edits), F.floor(chars / CHARS_AN_EDIT))).cast("int")


def keyed(work: DataFrame, edits: int) -> DataFrame:
    """Rows (id, name, key, edits, both, at, width) of texts (id, name, context, edits, rest).

    Keys are (context, length, segment number, segment); ``both`` rows index and probe. The
    edits of a key are those of its length if the text has none yet, so a text probes a
    shorter length with that length's segments. The probes are exploded first and one
    expression makes the key of each: an array of all keys makes code too large for the compiler.
    """
    kinds = F.array(
        *[
            F.array(
                *[
                    F.struct(
                        F.lit(e).alias("edits"), F.lit(d).alias("delta"), F.lit(i).alias("part"), F.lit(s).alias("shift")
                    )
                    for d, i, s in probes(e)
                ]
            )
            for e in range(1, edits + 1)
        ]
    )
    # A text of the first length of its class also probes lengths of the class below.
    rows = work.withColumn("_n", F.char_length("rest")).withColumn(
        "_most", F.coalesce("edits", edits_of(F.col("_n"), edits))
    )
    least = F.coalesce("edits", edits_of(F.col("_n") - F.col("_most"), edits))
    rows = rows.withColumn("_class", F.explode(F.sequence(least, "_most"))).select(
        "id", "name", "context", "rest", "_n", F.col("edits").alias("_fixed"),
        F.explode(F.get(kinds, F.col("_class") - 1)).alias("p"),
    )
    rows = rows.withColumn("_length", F.col("_n") - F.col("p.delta"))
    rows = rows.filter(F.coalesce("_fixed", edits_of(F.col("_length"), edits)) == F.col("p.edits")).withColumn(
        "_start", F.expr("CAST(_length * p.part DIV (p.edits + 1) AS INT)")
    )
    at = F.col("_start") + F.col("p.shift")
    width = F.expr("CAST(_length * (p.part + 1) DIV (p.edits + 1) AS INT)") - F.col("_start")
    fits = (at >= 0) & (at + width <= F.col("_n")) & (F.col("_length") >= 0)
    return rows.filter(fits).select(
        "id",
        "name",
        F.xxhash64("context", "_length", "p.part", F.col("rest").substr(at + 1, width)).alias("key"),
        F.col("p.edits").alias("edits"),
        ((F.col("p.delta") == 0) & (F.col("p.shift") == 0)).alias("both"),
        at.alias("at"),
        width.alias("width"),
    )


def shared(rows: DataFrame) -> DataFrame:
    """Keys of at least two different texts, one of them indexed."""
    return (
        rows.groupBy("key")
        .agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max("both").alias("indexed"))
        .filter("a <> b AND indexed")
        .select("key")
    )


def within(a: Column, b: Column, edits: int | Column) -> Column:
    """Whether two arrays of characters are within the edits (10 at most), by a bit-parallel band.

    Bit k + edits of state e stands for "the first i characters of a and the first i + k of b
    are within e edits". A step takes one character of a and moves whole states: matches keep
    their bit, a substitution takes it from e - 1, a deletion shifts it down, an insertion up.
    """
    edits = F.lit(edits) if isinstance(edits, int) else edits
    n, m, none = F.size(a), F.size(b), F.array().cast("array<int>")

    def left(value: Column, by: Column) -> Column:
        return F.call_function("shiftleft", value, by)

    one = F.lit(1)
    full = left(one, 2 * edits + 1) - 1
    counts = F.sequence(F.lit(0), edits)
    first = F.transform(counts, lambda e: left(left(one, e + 1) - 1, edits))

    def step(states, i):
        same = F.aggregate(
            F.sequence(-edits, edits),
            F.lit(0),
            lambda bits, k: bits.bitwiseOR(F.when(F.get(b, i + k) == F.get(a, i), left(one, k + edits)).otherwise(0)),
        )

        def state(done, e, same):
            before = F.get(states, e - 1)
            moved = before.bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(F.get(done, e - 1), 1))
            now = F.get(states, e).bitwiseAND(same).bitwiseOR(F.coalesce(moved, F.lit(0)))
            return F.concat(done, F.array(now.bitwiseAND(full)))

        return F.get(
            F.transform(F.array(same), lambda x: F.aggregate(counts, none, lambda done, e: state(done, e, x))), 0
        )

    chars = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    end = F.aggregate(chars, first, step, lambda states: F.get(states, edits))
    inside = F.abs(m - n) <= edits
    return inside & F.coalesce(
        F.call_function("shiftright", end, m - n + edits).bitwiseAND(one) == 1, F.lit(False)
    )


def signature(line: Column) -> list[Column]:
    """Two longs: how often each of the letters a to z occurs, modulo 8, in four bits a letter.

    Codes of neighbouring counts differ in one bit, so an edit changes 2 bits at most.
    """
    codes = F.array(*[F.lit(c).cast("long") for c in (0, 1, 3, 7, 15, 14, 12, 8)])

    def bits(letter: str, at: int) -> Column:
        count = F.char_length(line) - F.char_length(F.translate(line, letter, ""))
        return F.shiftleft(F.get(codes, F.pmod(count, F.lit(8))), 4 * at)

    return [reduce(Column.bitwiseOR, [bits(c, k) for k, c in enumerate(half)]) for half in ("abcdefghijklm", "nopqrstuvwxyz")]


def may_be_within(edits: Column) -> Column:
    """False only for sides a and b (n, x, y: length and signature) beyond the edits."""
    changes = sum(F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in "xy")
    return (F.abs(F.col("a.n") - F.col("b.n")) <= edits) & (changes <= 2 * edits)


def common_prefix(a: Column, b: Column) -> Column:
    """Number of equal characters at the start of two strings, by halving steps."""
    least = F.least(F.char_length(a), F.char_length(b))
    powers = F.transform(F.sequence(F.lit(30), F.lit(0), F.lit(-1)), lambda i: F.call_function("shiftleft", F.lit(1), i))

    def further(done, step):
        same = (done + step <= least) & (a.substr(done + 1, step) == b.substr(done + 1, step))
        return F.when(same, done + step).otherwise(done)

    return F.aggregate(F.filter(powers, lambda p: p <= least), F.lit(0), further)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def differing(a: Column, b: Column) -> Column:
    """Both strings, as a struct, without the start and the end that they share.

    Their edit distance stays as it is.
    """

    def without_start(x):
        def cut(p):
            return F.struct(
                *[F.reverse(x[c].substr(p + 1, F.char_length(x[c]))).alias(c) for c in ("a", "b")]
            )

        return bound(common_prefix(x["a"], x["b"]), cut)

    return bound(bound(F.struct(a.alias("a"), b.alias("b")), without_start), without_start)


def near_rows(texts: DataFrame, wanted, edits: int, work: WorkTables) -> tuple[DataFrame, DataFrame]:
    """Rows (key, id, both): all different texts within the edits share a key, one of them as ``both``.

    ``texts`` has (id, line), repeated freely; ``wanted(ids)`` gives one row (id, line, ..) for
    each of the ids, and is returned as well. Keys of a single text are dropped by an aggregation
    that combines on the map side. A hot key, shared by many texts, is left out: its texts must be
    near in what the shared segment leaves, so that remainder is cut into segments again, with
    the edits of the key, up to SPLITS times.
    """
    first = texts.select(
        "id",
        F.col("id").alias("name"),
        F.lit(0).cast("long").alias("context"),
        F.lit(None).cast("int").alias("edits"),
        F.col("line").alias("rest"),
    )
    rows = keyed(first, edits)
    keys = work(shared(rows), "line-keys")
    # Most keys are no one else's: the bits hold these back before the rows are shuffled. A filter
    # does not pass the explode, below which it would work out the key of every row anew.
    rows = rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("row")).select("row.*")
    rows = work(rows.filter(may_be_among(keys, "key")).join(keys, "key").distinct(), "line-rows")
    known = work(wanted(rows.select("id").distinct()), "line-texts")
    todo = known.select(F.col("id").alias("name"), F.col("line").alias("rest"))
    each = F.array(*[F.lit(len(probes(e))) for e in range(1, edits + 1)])
    found = None
    for level in range(SPLITS + 1):
        load = rows.groupBy("key").agg(
            F.sum(F.col("both").cast("long")).alias("indexed"),
            F.count("*").alias("rows"),
            F.first("edits").alias("edits"),
        )
        pairs = F.col("indexed") * F.col("rows")
        large = (F.col("indexed") > HOT_PAIRS) & (F.col("indexed") > F.get(each, F.col("edits") - 1))
        load = work(load.select("key", "rows", pairs.alias("pairs"), large.alias("large")), "line-load")
        hot = load.filter("large")
        many = hot.agg(F.sum("pairs")).first()[0] or 0
        split = level < SPLITS and many > (load.agg(F.sum("rows")).first()[0] or 0)
        load = load.withColumn("hot", F.col("large") & F.lit(split))
        cold = rows.join(load.filter("NOT hot"), "key")
        cold = cold.select("key", "id", "both")
        found = cold if found is None else found.unionByName(cold)
        if not split:
            break
        again = rows.join(load.filter("hot").select("key"), "key").join(todo.select("name", "rest"), "name")
        rest = F.concat(
            F.col("rest").substr(F.lit(1), F.col("at")),
            F.col("rest").substr(F.col("at") + F.col("width") + 1, F.char_length("rest")),
        )
        again = again.select("id", F.col("key").alias("context"), "edits", rest.alias("rest")).distinct()
        todo = work(again.withColumn("name", F.xxhash64("id", "context", "rest")), "line-rests")
        deeper = keyed(todo, edits)
        rows = work(deeper.join(shared(deeper), "key").distinct(), "line-rows")
    return found, known


def later_copies(rows: DataFrame, known: DataFrame, edits: int, work: WorkTables) -> DataFrame:
    """Ids of the texts that have an earlier one within the edits.

    ``rows`` and ``known`` come from :func:`near_rows`, ``known`` with first, n, x and y. A text needs
    one earlier partner, not all: it is tried with the earliest text of each of its keys, then,
    if still open, with its earliest likely partner and only then with the others. So copies of
    one text do not meet in all pairs.
    """
    sides = rows.join(known.select("id", "first", "n", "x", "y"), "id")
    side = F.struct("first", "id", "n", "x", "y", "both")
    apart = edits_of(F.least("a.n", "b.n"), edits)
    pair = [F.col("b.id").alias("id"), F.col("a.id").alias("other"), F.col("a.first").alias("first")]
    likely = (F.col("a.first") < F.col("b.first")) & (F.col("a.both") | F.col("b.both")) & may_be_within(apart)

    def confirmed(pairs: DataFrame) -> DataFrame:
        text = known.select("id", "line", "n")
        others = known.select(F.col("id").alias("other"), F.col("line").alias("other_line"), F.col("n").alias("other_n"))
        pairs = pairs.join(text, "id").join(others, "other")
        rest = differing(F.col("line"), F.col("other_line")).alias("x")
        rests = pairs.select("id", edits_of(F.least("n", "other_n"), edits).alias("edits"), rest)
        letters = [F.when(F.col(f"x.{s}") == "", F.array().cast("array<string>")).otherwise(F.split(f"x.{s}", "")).alias(s) for s in "ab"]
        # Stored, or the band would take the strings apart anew for every letter that it looks at.
        rests = work(rests.select("id", "edits", *letters), "line-rests")
        return work(rests.filter(within(F.col("a"), F.col("b"), F.col("edits"))).select("id").distinct(), "line-near")

    pivots = sides.filter("both").groupBy("key").agg(F.min(side).alias("a"))
    stars = sides.select("key", side.alias("b")).join(pivots, "key").filter(likely).select(*pair).distinct()
    stars = work(stars, "line-stars")
    near = confirmed(stars.select("id", "other"))
    late = sides.join(near, "id", "left_anti").select("key", side.alias("b"))
    pairs = late.join(sides.select("key", side.alias("a")), "key").filter(likely).select(*pair).distinct()
    pairs = work(pairs.join(stars, ["id", "other"], "left_anti"), "line-pairs")
    first = work(pairs.groupBy("id").agg(F.min(F.struct("first", "other")).alias("a")).select("id", "a.other"), "line-firsts")
    more = confirmed(first)
    rest = pairs.select("id", "other").join(first, ["id", "other"], "left_anti").join(more, "id", "left_anti")
    return near.unionByName(more).unionByName(confirmed(rest)).distinct()


def may_be_among(ids: DataFrame, name: str = "id") -> Column:
    """Whether the column may be among the values: one bit per slot, never wrongly no."""
    slot = F.pmod(name, F.lit(SLOTS))
    word = F.shiftright(slot, 6).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(name, F.lit(64)).cast("int"))
    filled = ids.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    words = ids.sparkSession.range(SLOTS >> 6).select(F.col("id").cast("int").alias("word"))
    pair = F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    rows = words.join(filled, "word", "left").agg(F.sort_array(F.collect_list(pair)).alias("words"))
    bits = rows.select(F.transform("words", lambda x: x["bits"]).alias("bits")).scalar()
    return F.get(bits, word).bitwiseAND(bit) != 0


def dedup(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    edits: int = MAX_EDITS,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """Every document without the lines that an earlier line equals or nearly equals.

    Lines are what stands between line feeds. Lines are in the order of (id, position); a line
    goes if an equal one is earlier, or if one of at least ``least_chars`` characters, as it has
    itself, first occurs earlier and is near: within one edit for each CHARS_AN_EDIT characters
    of the shorter of both, at least one and ``edits`` at most. Lines of white space only stay
    and do not count. What remains is joined by line feeds.

    Documents are identified by id and text, so rows that repeat both keep the same lines, and
    an id may be null (it is the smallest) or have several texts. A null text stays null with
    0 lines. Texts are compared whole. An empty table gives no rows; other columns pass, and
    columns named like the results are replaced.

    Adds n_lines, n_exact, n_near (lines removed) and replaces ``text``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.drop("n_lines", "n_exact", "n_near")
    # Columns of the caller may have any names: they wait in a struct while others are added.
    docs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key), F.col(text))
    docs = docs.withColumn("_th", F.xxhash64(body))
    lines = (
        docs.select(F.col(key).alias("_id"), "_th", F.posexplode(F.split(body, "\n")).alias("pos", "line"))
        .filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
        .withColumns({"id": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), "line")})
    )
    place = F.struct("_id", "pos", "_th")
    work = WorkTables()
    firsts = work(
        lines.groupBy("id", "id2").agg(F.min(place).alias("first"), F.count("*").alias("copies")), "line-firsts"
    )
    long = lines.filter(F.char_length("line") >= least_chars).select("id", "line", place.alias("first"))

    def wanted(ids: DataFrame) -> DataFrame:
        found = (
            long.filter(may_be_among(ids))
            .join(ids, "id", "left_semi")
            .groupBy("id")
            .agg(F.min("first").alias("first"), F.min("line").alias("line"))
        )
        x, y = signature(F.col("line"))
        return found.select("*", F.char_length("line").alias("n"), x.alias("x"), y.alias("y"))

    rows, known = near_rows(long.select("id", "line"), wanted, edits, work)
    later = work(later_copies(rows, known, edits, work).withColumn("near", F.lit(True)), "line-later")
    status = (
        F.when(~place.eqNullSafe(F.col("first")), EXACT).when(F.col("near"), NEAR).otherwise(KEEP)
    )
    repeated = firsts.filter("copies > 1").select("id", "id2", "first")
    marked = (
        lines.select("_id", "_th", "pos", "id", "id2")
        .join(work(repeated, "line-repeated"), ["id", "id2"], "left")
        .join(later, "id", "left")
        .withColumn("first", F.coalesce("first", place))
        .select("_id", "_th", "pos", status.alias("status"))
    )
    gone = materialize(
        marked.filter(F.col("status") != KEEP)
        .groupBy(F.col("_id").alias("_gid"), F.col("_th").alias("_gth"))
        .agg(F.collect_set(F.struct("pos", "status")).alias("gone")),
        "line-gone",
    )
    work.remove()
    out = docs.join(gone, F.col(key).eqNullSafe(F.col("_gid")) & (F.col("_th") == F.col("_gth")), "left")
    out = out.withColumns(
        {
            "_lines": F.split(body, "\n"),
            "_at": F.map_from_entries("gone"),
        }
    )
    counted = F.size(F.filter("_lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    kept = F.array_join(F.filter("_lines", lambda x, i: ~F.map_contains_key("_at", i)), "\n")

    def number(kind: int) -> Column:
        return F.coalesce(F.size(F.filter("gone", lambda x: x["status"] == kind)), F.lit(0)).cast("long")

    out = out.withColumns(
        {
            "n_lines": counted,
            "n_exact": F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(number(EXACT)),
            "n_near": F.when(F.col("gone").isNull(), F.lit(0).cast("long")).otherwise(number(NEAR)),
            "_text": F.when(F.col("gone").isNull(), F.col(text)).otherwise(kept),
        }
    )
    names = docs.schema["_row"].dataType.names
    return out.select(
        *[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in names],
        "n_lines",
        "n_exact",
        "n_near",
    )
