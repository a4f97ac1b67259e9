"""Deterministic hashes that other systems compute too: FNV-1a, hash buckets, content hashes, coordinates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The FNV-1a offset bases and primes.
OFFSET32, PRIME32 = 0x811C9DC5, 0x01000193
OFFSET64_HIGH, OFFSET64_LOW, PRIME64_HIGH, PRIME64_LOW = 0xCBF29CE4, 0x84222325, 0x100, 0x1B3
MASK = 0xFFFFFFFF


def byte_values(text: Column) -> Column:
    """The UTF-8 bytes of a text as numbers."""
    hexed = F.hex(F.encode(text, "UTF-8"))
    pairs = F.when(F.length(hexed) > 0, F.transform(F.sequence(F.lit(1), F.length(hexed) - 1, F.lit(2)), lambda i: F.substr(hexed, i, F.lit(2))))
    return F.transform(F.coalesce(pairs, F.array().cast("array<string>")), lambda h: F.conv(h, 16, 10).cast("long"))


def fnv32(text: Column) -> Column:
    step = lambda h, b: (h.bitwiseXOR(b) * PRIME32).bitwiseAND(MASK)
    return F.aggregate(byte_values(text), F.lit(OFFSET32).cast("long"), step)


def fnv64(text: Column) -> Column:
    """struct(high, low): the two 32-bit halves, as unsigned numbers; products stay inside a long."""
    start = F.struct(F.lit(OFFSET64_HIGH).cast("long").alias("high"), F.lit(OFFSET64_LOW).cast("long").alias("low"))

    def step(h, b):
        low = h["low"].bitwiseXOR(b)
        product = low * PRIME64_LOW
        carry = F.shiftrightunsigned(product, 32)
        return F.struct((h["high"] * PRIME64_LOW + low * PRIME64_HIGH + carry).bitwiseAND(MASK).alias("high"), product.bitwiseAND(MASK).alias("low"))

    return F.aggregate(byte_values(text), start, step)


def hash_bucket(text: Column, n: int) -> Column:
    """The first eight hex digits of the MD5, modulo n."""
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(n))


def page_hashes(url: Column, body: Column) -> tuple[Column, Column]:
    return F.sha2(url, 256).alias("url_hash"), F.sha2(body, 256).alias("content_hash")


# Centres of suburbs (latitude, longitude), the default centre, and the scatter in degrees.
CENTRES = {
    "SURFERS PARADISE": (-28.0027, 153.4276),
    "BROADBEACH": (-28.0319, 153.4310),
    "BROADBEACH WATERS": (-28.0299, 153.4080),
    "BURLEIGH HEADS": (-28.0886, 153.4521),
    "BURLEIGH WATERS": (-28.0950, 153.4290),
    "MERMAID BEACH": (-28.0429, 153.4367),
    "MERMAID WATERS": (-28.0500, 153.4170),
    "MIAMI": (-28.0700, 153.4406),
    "PALM BEACH": (-28.1130, 153.4640),
    "CURRUMBIN": (-28.1390, 153.4810),
    "CURRUMBIN WATERS": (-28.1430, 153.4630),
    "ELANORA": (-28.1290, 153.4520),
    "TUGUN": (-28.1460, 153.4880),
    "COOLANGATTA": (-28.1690, 153.5380),
    "KIRRA": (-28.1665, 153.5260),
    "BILINGA": (-28.1540, 153.5070),
    "SOUTHPORT": (-27.9648, 153.4053),
    "LABRADOR": (-27.9560, 153.4090),
    "BIGGERA WATERS": (-27.9420, 153.3970),
    "RUNAWAY BAY": (-27.9300, 153.3970),
    "PARADISE POINT": (-27.8870, 153.3900),
    "HOLLYWELL": (-27.9090, 153.3990),
    "HOPE ISLAND": (-27.8770, 153.3470),
    "HELENSVALE": (-27.9040, 153.3300),
    "OXENFORD": (-27.8960, 153.3110),
    "UPPER COOMERA": (-27.8920, 153.3060),
    "COOMERA": (-27.8520, 153.3050),
    "PIMPAMA": (-27.8170, 153.3030),
    "ORMEAU": (-27.7460, 153.2740),
    "YATALA": (-27.7300, 153.2150),
    "ARUNDEL": (-27.9415, 153.3570),
    "PARKWOOD": (-27.9460, 153.3890),
    "MOLENDINAR": (-27.9690, 153.3760),
    "ASHMORE": (-28.0010, 153.3770),
    "BENOWA": (-27.9974, 153.3878),
    "BUNDALL": (-28.0050, 153.4108),
    "CARRARA": (-28.0210, 153.3650),
    "MUDGEERABA": (-28.0838, 153.3686),
    "ROBINA": (-28.0760, 153.3960),
    "VARSITY LAKES": (-28.0820, 153.4150),
    "CLEAR ISLAND WATERS": (-28.0410, 153.3940),
    "MERRIMAC": (-28.0490, 153.3700),
    "REEDY CREEK": (-28.1000, 153.3950),
    "TALLAI": (-28.0700, 153.3370),
    "MAUDSLAND": (-27.9420, 153.3050),
    "LOWER BEECHMONT": (-28.0790, 153.2480),
    "CURRUMBIN VALLEY": (-28.1850, 153.4350),
    "TALLEBUDGERA": (-28.1420, 153.4060),
    "TALLEBUDGERA VALLEY": (-28.1830, 153.3680),
    "BONOGIN": (-28.1240, 153.3660),
    "JACOBS WELL": (-27.7850, 153.3625),
    "LUSCOMBE": (-27.7680, 153.2410),
}
DEFAULT_CENTRE, SCATTER = (-28.005, 153.405), 0.012


def with_coordinates(df: DataFrame, app_id: str, suburb: str, centres: DataFrame | None = None) -> DataFrame:
    """df with lat and lng: the suburb's centre (or the default), moved by the halves of the id's FNV-1a.

    centres (suburb, lat, lng) replaces the built-in table; it is small and joined by broadcast only
    if Spark finds it so.
    """
    if centres is None:
        at = lambda i: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in CENTRES.items() for x in (k, v[i])]), F.upper(F.col(suburb))), F.lit(DEFAULT_CENTRE[i]))
        base = df.withColumn("_lat", at(0)).withColumn("_lng", at(1))
    else:
        c = centres.select(F.upper("suburb").alias("_suburb"), F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
        base = df.join(c, F.upper(F.col(suburb)) == F.col("_suburb"), "left").drop("_suburb").withColumns({"_lat": F.coalesce("_lat", F.lit(DEFAULT_CENTRE[0])), "_lng": F.coalesce("_lng", F.lit(DEFAULT_CENTRE[1]))})
    spread = lambda half: half / F.lit(float(MASK)) * 2.0 - 1.0
    h = fnv64(F.col(app_id))
    return base.withColumn("_h", h).withColumns({"lat": F.col("_lat") + spread(F.col("_h.high")) * SCATTER, "lng": F.col("_lng") + spread(F.col("_h.low")) * SCATTER}).drop("_h", "_lat", "_lng")
