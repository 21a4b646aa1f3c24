import pytest

from tidemark.llm.address_parse import Address, deletions, one_edit, parse, place_of, same_name
from tidemark.llm.addresses import place_pairs, same_places

TOWNS, STATES = {"HARWICK", "EASTON"}, {"WESTMARK"}


@pytest.mark.parametrize(
    "raw,want",
    [
        ("12 Alder St., Harwick", Address("A", "12", ("ALDER",), ("ST",), "", "HARWICK")),
        ("Harwick: Alder street, no. 12 S.W.", Address("A", "12", ("ALDER",), ("ST",), "SW", "HARWICK")),
        ("APT. 4, 0012 ALDER STR NE (Easton)", Address("A", "12", ("ALDER",), ("ST",), "NE", "EASTON")),
        ("southeast 12 Alder Pkwy, rear, Easton, Westmark", Address("A", "12", ("ALDER",), ("PKWY",), "SE", "EASTON")),
        ("the 600 block of Alder Ave", Address("B", "600", ("ALDER",), ("AVE",), "", "")),
        ("Alder Rd. 600 block Harwick", Address("B", "600", ("ALDER",), ("RD",), "", "HARWICK")),
        ("Birch Ln / Alder Ave, Harwick", Address("X", "", ("ALDER", "BIRCH"), ("AVE", "LN"), "", "HARWICK")),
        ("Alder Av, corner of Birch Lane", Address("X", "", ("ALDER", "BIRCH"), ("AVE", "LN"), "", "")),
        ("306 3 Av Harwick", Address("A", "306", ("#3",), ("AVE",), "", "HARWICK")),
        ("Third Avenue 306 #6A", Address("A", "306", ("#3",), ("AVE",), "", "")),
        ("16 avenue 410, harwick, westmark", Address("A", "410", ("#16",), ("AVE",), "", "HARWICK")),
        ("12 Alder", Address("A", "12", ("ALDER",), ("",), "", "")),
        ("100 Oak Hill Rd", Address("A", "100", ("OAK HILL",), ("RD",), "", "")),
        ("100 Oak Grove Ave, Harwick", Address("A", "100", ("OAK GROVE",), ("AVE",), "", "HARWICK")),
        ("12 St Marks Pl", Address("A", "12", ("ST MARKS",), ("PL",), "", "")),
        ("7 La Salle Ave, Easton", Address("A", "7", ("LA SALLE",), ("AVE",), "", "EASTON")),
        ("12 Avenue of the Americas", Address("A", "12", ("AVENUE AMERICAS",), ("",), "", "")),
        ("1500 Avenue A", Address("A", "1500", ("AVENUE A",), ("",), "", "")),
        ("12-14 Oak St", Address("A", "12-14", ("OAK",), ("ST",), "", "")),
        ("12-A Oak St", Address("A", "12A", ("OAK",), ("ST",), "", "")),
        ("12 1/2 Oak St", Address("A", "12 1/2", ("OAK",), ("ST",), "", "")),
        ("1200 K St NW", Address("A", "1200", ("K",), ("ST",), "NW", "")),
        ("1200 N St NW", Address("A", "1200", ("N",), ("ST",), "NW", "")),
        ("5 Park La Brea Ave", Address("A", "5", ("PARK LA BREA",), ("AVE",), "", "")),
        ("9 Dr Martin Luther King Blvd SE, Harwick", Address("A", "9", ("DR MARTIN LUTHER KING",), ("BLVD",), "SE", "HARWICK")),
        ("100 Oak St St Louis", Address("A", "100", ("OAK",), ("ST",), "", "ST LOUIS")),
        ("100 Oak St, San Jose, CA", Address("A", "100", ("OAK",), ("ST",), "", "SAN JOSE")),
        ("6 Front St, front", Address("A", "6", ("FRONT",), ("ST",), "", "")),
        ("8 First Parish Rd", Address("A", "8", ("FIRST PARISH",), ("RD",), "", "")),
        ("Oak Hill Rd and 5 Ave, Harwick", Address("X", "", ("#5", "OAK HILL"), ("AVE", "RD"), "", "HARWICK")),
        ("12 Ox Rd", Address("A", "12", ("OX",), ("RD",), "", "")),
        ("12 Alder St & Birch Ave & Fir Ln", Address("X", "", ("ALDER", "BIRCH & FIR"), ("ST", "AVE & LN"), "", "")),
        ("12 Alder Harwick", Address("A", "12", ("ALDER",), ("",), "", "HARWICK")),
        ("", Address()),
        (None, Address()),
    ],
)
def test_parse(raw, want):
    assert parse(raw, {}, TOWNS, STATES) == want


def test_edits():
    for a, b in (("ALDER", "ALDRE"), ("ALDER", "ALER"), ("ALDER", "ALDDER"), ("ALDER", "ALTER"), ("ALDER", "ALDER")):
        assert one_edit(a, b) and deletions(a) & deletions(b)
    assert not one_edit("ALDER", "ALBAR") and not one_edit("ELDYOWN", "YELDOWN")


def test_words_are_assigned():
    for a, b in (("OAK HILL", "HILL OAK"), ("OAK HILL", "HILL OAKK"), ("OAK HILL", "OAKHILL"), ("OAK HILL ROW", "ROW HILT OAK")):
        assert same_name(a, b) and deletions(a) & deletions(b)
    assert not same_name("OAK HILL", "OAK GROVE") and not same_name("OAK HILL", "OAKK HIL") and not same_name("OAK HILL", "OAK")


def test_vetoes_and_ties():
    sig = lambda t, q="", town="", n=1, hint=None: ((t, ""), q, town, n, hint)
    assert len(set(place_of([sig("ST"), sig("AVE"), sig("RD")]))) == 3
    assert place_of([sig("ST", "NW", "HARWICK"), sig("ST"), sig("", "", "HARWICK"), sig("ST", "NE")]) == [0, 2, 0, 1]
    a, b, vague = sig("ST", "", "HARWICK"), sig("ST", "", "EASTON"), sig("ST")
    assert len(set(place_of([a, b, vague]))) == 3  # fits both, so neither
    assert place_of([a, b, sig("ST", hint=(("ST", ""), "", "EASTON", 0, None))])[1:] == [0, 0] or place_of([a, b, sig("ST", hint=(("ST", ""), "", "EASTON", 0, None))])[2] == place_of([a, b])[1]


def table(spark, raws):
    return spark.createDataFrame([(i, r, "x") for i, r in enumerate(raws)], "addr_id bigint, addr_raw string, place_id string")


RAWS = (
    [f"{i} Alder St, Harwick" for i in range(100, 140)] + [f"{i} Birch Ave, Easton" for i in range(100, 140)] + ["Harwick: 101 Alder Street", "101 Aldre St., Apt 4", "101 Alder St (Easton)", "101 alder st", "101 Alder Ave, Harwick", None, "", "near the river", "101 Alder St, Harwick"]
)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_places(spark, limit):
    places = same_places(table(spark, RAWS), broadcast_names=limit)
    by = {r["addr_id"]: r["place_id"] for r in places.collect()}
    assert by[80] == by[1] and by[88] == by[1] and by[82] not in (by[1],) and by[84] == 84
    assert not {85, 86, 87} & set(by)
    pairs = {tuple(r) for r in place_pairs(places).collect()}
    assert (1, 80) in pairs and (80, 88) in pairs and all(a < b for a, b in pairs) and not any(84 in p for p in pairs)


NEAR = [
    "12 Radchurch Rd, Harwick", "12 Radchucrh Rd, Harwick", "12 Radchurch Rd", "14 Radchuch Rd, Harwick",  # 0-3: a street, as rare as its misspelling
    "7 Holt St, Emberton", "7 Holt St, Embberton", "7 Holt Ave, Embberton",  # 4-6: a town
    "Birch Ln / Radchurch Rd, Harwick", "Radchucrh Rd and Birch Ln, Harwick", "Rad church Rd / Birchh Ave, Harwick",  # 7-9: a crossing
    "3 Mossgate Rd NW", "3 Mosgate Rd SE", "16 3rd St, Harwick", "16 4th St, Harwick",  # 10-13: quadrants and ordinals differ
]


@pytest.mark.parametrize("limit", [500_000, 0])
def test_rare_names_one_edit_apart_in_a_block(spark, limit):
    pairs = {tuple(r) for r in place_pairs(same_places(table(spark, NEAR), broadcast_names=limit)).collect()}
    assert pairs == {(0, 1), (0, 2), (1, 2), (4, 5), (7, 8)}


def test_established_names_one_edit_apart_stay_two(spark):
    raws = [f"{i} Halhaven St, Harwick" for i in range(100, 112)] + [f"{i} Falhaven St, Harwick" for i in range(100, 115)]
    assert place_pairs(same_places(table(spark, raws))).count() == 0


def test_long_names_stay_apart(spark):
    raws = ["100 Oak Hill Rd", "100 Oak Grove Ave", "100 Oak Hill Road, Apt 4", "100 Hill Oak Rd", "100 Oak Grove", "12 St Marks Pl", "12 St. Marks Place #3", "12 Marks St", "12-14 Oak St", "12 Oak St", "1500 Avenue A", "1500 Avenue B"]
    assert {tuple(r) for r in place_pairs(same_places(table(spark, raws))).collect()} == {(0, 2), (0, 3), (2, 3), (1, 4), (5, 6)}


def test_empty(spark):
    assert same_places(table(spark, [])).count() == 0
    assert same_places(table(spark, [None, "", "?"])).count() == 0


def test_repeated_rows_in_one_place(spark):
    df = spark.range(3000).selectExpr("id as addr_id", "'12 Alder St, Harwick' as addr_raw")
    assert same_places(df).select("place_id").distinct().count() == 1
