import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kerbside.functions import text
from kerbside.operators.silver import parse_messages
from kerbside.schemas import MESSAGE_SCHEMA

D, H = "driver_request", "hitcher_request"
CLASSIFIED = [
    # One message for each rule, in the order of the rules.
    ("bikers looking for pillions, tampines to yishun", None),
    ("Pillion looking for biker tonight", None),
    ("good evening, driver looking for passengers, yishun to bedok", D),
    ("tonight looking for passengers, lakeside to punggol", D),
    ("7 seater available. pickup: lakeside, drop: punggol", D),
    ("HITCHER LOOKING FOR DRIVERS to punggol", H),
    ("anyone? looking for driver, two of us", H),
    ("pickup lakeside 6pm, drop punggol", H),
    ("thanks to the driver and the hitcher of yesterday", None),
    ("pickup lakeside only", None),
    # A leading newline is not trimmed, so the anchored rule does not see the biker.
    ("\nBiker looking for pillion pick up x drop y", H),
    (None, None),
]


def apply(spark, build, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [r[1] for r in sorted(df.select("n", build(F.col("v")).alias("r")).collect())]


def test_classification(spark):
    assert apply(spark, text.classify_request, [m for m, _ in CLASSIFIED]) == [c for _, c in CLASSIFIED]


def test_border_routes_collapse_to_the_first_side(spark):
    given = ["SG🇸🇬🇸🇬", "🇲🇾 JB", "jb sg", "sg to jb", "SG / JB", "JB🇲🇾🇸🇬SG", "Sgp Plaza", "Jbel Lane", "Lakeside sg", "🇲🇾🇲🇾", "Punggol ...", None]
    want = ["SG", "JB", "jb", "sg to jb", "sg", "jb", "Sgp Plaza", "Jbel Lane", "Lakeside sg", None, "Punggol", None]
    assert apply(spark, lambda c: text.collapse_border_route(text.strip_flags(c)), given) == want


@pytest.mark.parametrize(("message", "count"), [
    ("Pax: 1-6", 3), ("Pax: 2-4", 3), ("Pax: 1-5", 3), ("Pax: 2-3", 2), ("Pax: 100", 1), ("Pax: 6-1", 6),
    ("2-3 pax", None), ("pax 0", None), ("pax:11", None), ("pax nil", None), ("Whole car pax 3", None),
    ("no label", 1), ("pax: 2-3 pax", 2), ("4 passengers", 4), ("Pax: n/a", None), ("Pax – 2", 1), ("pax 3–5", 4),
])
def test_passenger_count(spark, message, count):
    got = apply(spark, lambda c: text.resolve_pax(c, text.extract_pax_fields(c)), [message])
    assert got == [count]


def _message(spark, body):
    at = ts("2024-01-02 10:00:00.500")
    return spark.createDataFrame([("c", None, 1, at, body, 5, "@u", at)], MESSAGE_SCHEMA)


def test_whole_message_and_its_reverse(spark):
    body = ("Evening all, driver looking for passengers\nTime: now\n"
            "Pick up: JB🇲🇾SG\nDrop off: SG🇸🇬JB\nPax: 2-4\nmessage me")
    back = body.replace("JB🇲🇾SG", "?").replace("SG🇸🇬JB", "JB🇲🇾SG").replace("?", "SG🇸🇬JB")
    for message, places in ((body, ("jb", "sg")), (back, ("sg", "jb"))):
        r = parse_messages(_message(spark, message)).collect()[0]
        assert (r.pickup_location, r.dropoff_location, r.pax_count) == (*places, 3)
        assert (r.request_type, r.request_time_text, r.parse_status) == (D, "2024-01-02 10:00:00.5", "parsed")


def test_empty_label_takes_the_next_line(spark):
    assert apply(spark, text.extract_pickup, ["Pick up:\nDrop off: SG\n"]) == ["Drop off: SG"]
    assert apply(spark, text.extract_pickup, ["Pick up:   ", "from: A", "Pickup location : B \r\nx"]) == [None, "A", "B"]


def test_missing_fields(spark):
    base = "Looking for driver\n"
    for extra, status in (("Drop off: A\nTime: 6", "missing_pickup"), ("Pick up: A\nTime: 6", "missing_dropoff"),
                          ("Pick up: A\nDrop off: B", "missing_time"), ("From: A\nTo: B\nWhen: 6", "parsed")):
        assert parse_messages(_message(spark, base + extra)).collect()[0].parse_status == status


def test_identifiers(spark):
    assert apply(spark, text.canonical_channel, ["RideGroup", "Ridegroup", " @RideGroup ", "@@x"]) == ["ridegroup"] * 3 + ["x"]
    assert apply(spark, text.sender_handle, ["mina", "@mina", "@@g", "", None]) == ["@mina", "@mina", "@g", None, None]


def test_places(spark):
    assert apply(spark, text.normalize_location, ["  KSL \t City ", "   ", None]) == ["ksl city", None, None]
    assert apply(spark, text.postal_codes_in_text, ["123456/654321 or 123456 and 1234567", "none"]) == [["123456", "654321"], []]
    got = apply(spark, text.search_fallbacks, [
        "vivo lobby", "a hotel main entrance", "lobby", "x lobby lobby lobby lobby lobby lobby", "mall drop  off point", "plain"])
    assert got == [["vivo lobby", "vivo"], ["a hotel main entrance", "a hotel", "a"], ["lobby"],
                   ["x" + " lobby" * n for n in range(6, -1, -1)], ["mall drop  off point", "mall"], ["plain"]]


def test_guards_do_not_change_the_classification(spark):
    """The substring tests in front of each regex only skip work."""
    from kerbside.functions import patterns as P
    words = ["driver", "looking", "for", "passenger", "pick up", "drop", "hitcher", "pillion", "biker", "whole car"]
    texts = [" ".join([a, b, c, d]) for a in words for b in words for c in words[:5] for d in words[3:7]]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    m = F.col("m")
    route = m.rlike(P.PICKUP_WORD) & m.rlike(P.DROP_WORD)
    plain = (F.when(m.rlike(P.BIKER_PILLION), None)
             .when(m.rlike(P.DRIVER_LOOKING) | m.rlike(P.LOOKING_FOR_PASSENGER) | (m.rlike(P.VEHICLE) & route), D)
             .when(m.rlike(P.HITCHER_LOOKING) | m.rlike(P.LOOKING_FOR_DRIVER) | route, H))
    assert df.where(~plain.eqNullSafe(text.classify_request(m))).count() == 0
    assert rows(df.groupBy(text.classify_request(m)).count())
