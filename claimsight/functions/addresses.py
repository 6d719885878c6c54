"""Network addresses as 32 hex digits, networks by prefix, and client names of user agents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"(?:{_OCTET}\.){{3}}{_OCTET}"
#: Hex digits that stand before the four bytes of an IPv4 address.
MAPPED = "0" * 20 + "ffff"
IPV4_BITS = 96


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(value)), digits, "0")


def _bare(text: Column) -> Column:
    """The address without port, brackets and zone; null if it has no such form."""
    text = F.lower(F.trim(text))
    forms = [r"^\[([0-9a-f:.]+)(?:%[^\]]*)?\](?::[0-9]{1,5})?$", r"^([0-9.]+)(?::[0-9]{1,5})?$", r"^([0-9a-f:.]+)(?:%.*)?$"]
    return F.coalesce(*[F.when(text.rlike(f), F.regexp_extract(text, f, 1)) for f in forms])


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _ipv4_digits(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, r"\."), lambda x: _hex(x.cast("int"), 2)), "")


def _groups(bare: Column) -> Column:
    """An IPv6 address with its IPv4 tail, if any, as two groups."""

    def replaced(tail: Column) -> Column:
        head = F.left(bare, F.char_length(bare) - F.char_length(tail))
        return _once(
            _ipv4_digits(tail),
            lambda four: F.concat(head, F.left(four, F.lit(4)), F.lit(":"), F.right(four, F.lit(4))),
        )

    ends = rf":({_IPV4})$"
    return F.when(bare.rlike(ends), _once(F.regexp_extract(bare, ends, 1), replaced)).otherwise(bare)


def _ipv6_digits(halves: Column) -> Column:
    """32 digits of the groups left and right of ``::``; null unless they make an address."""

    def parts(half: Column) -> Column:
        return F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))

    def padded(half: Column) -> Column:
        return F.array_join(F.transform(half, lambda g: F.lpad(g, 4, "0")), "")

    def joined(x: Column) -> Column:
        n = F.size(x["left"]) + F.size(x["right"])
        whole = F.when(F.size(halves) == 1, n == 8).otherwise((F.size(halves) == 2) & (n < 8))
        good = whole & F.forall(F.concat(x["left"], x["right"]), lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(good, F.concat(padded(x["left"]), F.repeat(F.lit("0000"), 8 - n), padded(x["right"])))

    right = F.coalesce(parts(F.get(halves, F.lit(1))), F.array().cast("array<string>"))
    return _once(F.struct(parts(F.get(halves, F.lit(0))).alias("left"), right.alias("right")), joined)


def address_digits(text: Column) -> Column:
    """128 bits of an IPv4 or IPv6 address as 32 hex digits, in the order of the addresses.

    IPv4 addresses are the mapped ones (``::ffff:a.b.c.d``), so both ways to write one are
    equal. A port, brackets and a zone are left out. Null for what is no address.
    """

    def digits(bare: Column) -> Column:
        six = _once(F.split(_groups(bare), "::", -1), _ipv6_digits)
        return F.when(bare.rlike(rf"^{_IPV4}$"), F.concat(F.lit(MAPPED), _ipv4_digits(bare))).otherwise(six)

    return _once(_bare(text), digits)


def prefix_digits(digits: Column, bits: Column) -> Column:
    """The first bits of an address: whole hex digits, and the next one with its other bits cleared."""
    whole = F.floor(bits / 4).cast("int")
    last = F.conv(digits.substr(whole + 1, F.lit(1)), 16, 10).cast("int")
    rest = F.call_function("shiftleft", F.lit(15), (4 - bits % 4).cast("int")).bitwiseAND(15)
    more = F.when(bits % 4 != 0, _hex(last.bitwiseAND(rest), 1)).otherwise("")
    return F.concat(F.left(digits, whole), more)


def network_bits(network: Column) -> Column:
    """Leading bits that a network in CIDR form fixes, of 128; a lone address fixes all."""
    size = F.try_element_at(F.split(network, "/"), F.lit(2)).try_cast("int")
    four = ~F.contains(network, F.lit(":"))
    bits = F.when(four & (size <= 32), size + IPV4_BITS).when(~four & (size <= 128), size)
    return F.when(F.contains(network, F.lit("/")), F.when(size >= 0, bits)).otherwise(128).cast("int")


def with_network(df: DataFrame, digits: str, networks: DataFrame, network: str, labels: list[str]) -> DataFrame:
    """Adds the labels of the smallest network that an address lies in; null if there is none.

    ``digits`` names a column of :func:`address_digits`, ``network`` one of CIDR texts. Every
    distinct address asks for its prefixes of the lengths in use, so networks are found by an
    equality join whatever their number, and a busy address is looked up once. Of networks that
    are repeated, the smallest labels win; texts that are no network are passed over. The
    labels replace columns of these names.
    """
    bits = network_bits(F.col(network))
    known = networks.select(
        bits.alias("_bits"),
        prefix_digits(address_digits(F.substring_index(network, "/", 1)), bits).alias("_prefix"),
        F.struct(*labels).alias("_label"),
    ).filter("_prefix IS NOT NULL")
    lengths = sorted(r[0] for r in known.select("_bits").distinct().collect())  # 129 at most
    if not lengths:
        none = {c: F.lit(None).cast(networks.schema[c].dataType) for c in labels}
        return df.withColumns(none)
    asked = df.select(F.col(digits).alias("_digits")).filter("_digits IS NOT NULL").distinct()
    asked = asked.withColumn("_bits", F.explode(F.array(*[F.lit(n) for n in lengths])))
    asked = asked.withColumn("_prefix", prefix_digits(F.col("_digits"), F.col("_bits")))
    found = (
        asked.join(known, ["_bits", "_prefix"])
        .groupBy("_digits")
        .agg(F.min(F.struct((-F.col("_bits")).alias("far"), "_label")).alias("_best"))
    )
    found = found.select("_digits", *[F.col(f"_best._label.{c}").alias(c) for c in labels])
    rest = df.drop(*labels)
    return rest.join(found, rest[digits] == found["_digits"], "left").drop("_digits")


# Product names of user agents, the first that occurs counts; then platforms.
CLIENTS = [
    ("bot", r"(?:[a-z]*bot|crawler|spider)(?:/([0-9]+))?"),
    ("edge", r"edg(?:e|a|ios)?/([0-9]+)"),
    ("opera", r"(?:opr|opera)/([0-9]+)"),
    ("firefox", r"(?:firefox|fxios)/([0-9]+)"),
    ("chrome", r"(?:chrome|crios)/([0-9]+)"),
    ("safari", r"version/([0-9]+)[0-9.]* (?:mobile/[0-9a-z]+ )?safari/"),
    ("curl", r"^curl/([0-9]+)"),
    ("python", r"^python-(?:requests|urllib)/([0-9]+)"),
]
PLATFORMS = [
    ("android", "android"),
    ("ios", "iphone|ipad"),
    ("windows", "windows"),
    ("macos", "mac os x|macintosh"),
    ("linux", "linux|x11"),
]


def _first(text: Column, kinds: list[tuple[str, str]]) -> Column:
    """Name of the first pattern that occurs, else "other"; null for null."""
    found = reduce(lambda so_far, kind: F.when(text.rlike(kind[1]), kind[0]).otherwise(so_far), kinds[::-1], F.lit("other"))
    return F.when(text.isNotNull(), found)


def client_of(agent: Column) -> Column:
    """Client of a user agent as (family, major, platform); null for null.

    ``major`` is the first number of its version, null where there is none.
    """

    def fields(text: Column, family: Column) -> Column:
        major = F.coalesce(*[F.when(family == k, F.regexp_extract(text, p, 1)) for k, p in CLIENTS], F.lit(""))
        return F.struct(
            family.alias("family"), major.try_cast("int").alias("major"), _first(text, PLATFORMS).alias("platform")
        )

    known = _once(F.lower(agent), lambda text: _once(_first(text, CLIENTS), lambda family: fields(text, family)))
    return F.when(agent.isNotNull(), known)
