"""Locations of addresses by the longest network prefix that contains them (IPv4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netvigil.session import materialize

ADDRESS_BITS = 32
# Networks up to this length can contain more addresses than one task should meet. They are at most 2 ** 17, so each is
# given once per salt and their addresses are spread over the salts; longer prefixes hold at most 2 ** 16 addresses.
SPREAD_LENGTH = 16
SALTS = 64
DOTTED = r"^\s*\d{1,3}(\.\d{1,3}){3}\s*$"
CIDR = r"^\s*\d{1,3}(\.\d{1,3}){3}/\d{1,2}\s*$"
PLACE = ["country", "country_code", "city", "latitude", "longitude", "asn"]


def address_number(ip: Column) -> Column:
    """A dotted IPv4 address as a number; anything else is NULL.

    The text is split once: filters on the number repeat this expression, and one split per octet made them slow.
    """
    octets = F.transform(F.split(F.trim(ip), r"\."), lambda octet: octet.try_cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda done, octet: F.when(octet < 256, done * 256 + octet))
    return F.when(ip.rlike(DOTTED), number)


def dotted(number: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(number, shift).bitwiseAND(F.lit(255).cast("long")).cast("string")
                              for shift in (24, 16, 8, 0)])


def prefix_of(number: Column, length: Column) -> Column:
    """The first ``length`` bits of an address."""
    return F.call_function("shiftright", number, (F.lit(ADDRESS_BITS) - length).cast("int"))


def parsed_networks(networks: DataFrame, network_column: str = "network") -> DataFrame:
    """One row per network: ``length``, ``prefix``, its text without bits beyond the prefix, and a struct of the other columns.

    Rows that are no network contain no address and are left out. Of rows for
    the same network the one with the smallest other columns counts.
    """
    text = F.col(network_column)
    others = [name for name in networks.columns if name != network_column]
    parts = F.split(F.trim("text"), "/")
    # Equal texts are merged first, so each is read once, behind a shuffle that spreads them.
    per_text = networks.where(text.rlike(CIDR)).groupBy(text.alias("text")).agg(F.min(F.struct(*others)).alias("about"))
    read = per_text.select(
        address_number(F.get(parts, 0)).alias("number"), F.get(parts, 1).cast("int").alias("length"), "about")
    valid = read.where((F.col("length") <= ADDRESS_BITS) & F.col("number").isNotNull())
    per_network = valid.select("length", prefix_of(F.col("number"), F.col("length")).alias("prefix"), "about").groupBy(
        "length", "prefix").agg(F.min("about").alias("about"))
    first = F.call_function("shiftleft", F.col("prefix"), F.lit(ADDRESS_BITS) - F.col("length"))
    return per_network.select("length", "prefix", F.concat(dotted(first), F.lit("/"), F.col("length").cast("string")).alias("network"),
                              "about")


def longest_prefix(addresses: DataFrame, networks: DataFrame, column: str = "source_ip") -> DataFrame:
    """The longest network that contains each distinct address: the address, ``network`` and ``about``.

    An address is joined by equality once per prefix length that occurs in the
    networks (33 at most); of its matches only the length goes into a maximum that
    merges on the map side, and the network of that length is then joined once. No
    ranges are compared, and an address counts once however many rows name it.
    Addresses without a network are not in the result.
    """
    known = materialize(parsed_networks(networks), "networks")
    lengths = [row[0] for row in known.select("length").distinct().orderBy("length").collect()]  # 33 at most
    salt = F.when(F.col("length") <= SPREAD_LENGTH, F.pmod(F.xxhash64(column), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    numbered = addresses.select(column).distinct().withColumn("number", address_number(F.col(column))).where("number IS NOT NULL")
    probes = numbered.select(column, "number", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias(
        "length")).select(column, "number", "length", prefix_of(F.col("number"), F.col("length")).alias("prefix"), salt.alias("salt"))
    salts = F.when(F.col("length") <= SPREAD_LENGTH, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(
        F.array(F.lit(0).cast("long")))
    spread = known.select("*", F.explode(salts).alias("salt"))
    # Only numbers are aggregated: a minimum of texts or structs would have to sort all matches.
    found = probes.join(spread.select("length", "prefix", "salt"), ["length", "prefix", "salt"])
    longest = found.groupBy(column, "number").agg(F.max("length").alias("length"))
    return longest.select(column, "length", prefix_of(F.col("number"), F.col("length")).alias("prefix"), salt.alias("salt")).join(
        spread, ["length", "prefix", "salt"]).select(column, "network", "about")


def with_network(table: DataFrame, networks: DataFrame, column: str = "source_ip") -> DataFrame:
    """``table`` with ``network`` and the columns of the network table, NULL where no network contains the address.

    The matches are written first, so that adaptive execution can split an address that most rows share.
    """
    others = [name for name in networks.columns if name != "network"]
    matches = materialize(longest_prefix(table, networks, column), "matches")
    return table.join(matches, column, "left").select(
        *[F.col(name) for name in table.columns], "network", *[F.col(f"about.{name}").alias(name) for name in others])


def geo_by_network(risk: DataFrame, networks: DataFrame) -> DataFrame:
    """Every source of a risk table on the map of a real network table (``network`` and the columns of ``PLACE``).

    The counterpart of ``geo_enriched`` for a site that has such a table. The scores
    are written first, as both their addresses and their rows are read.
    """
    located = with_network(materialize(risk, "risk"), networks.select("network", *PLACE))
    return located.select("source_ip", "network", *PLACE, F.col("total_flows").alias("flows_detected"), "risk_score", "risk_level")
