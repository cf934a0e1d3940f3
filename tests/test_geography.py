from __future__ import annotations

import datetime as dt
import json

import pytest

from skyground.functions.time import utc_timestamp
from skyground.operators import countries as C, places as P
from skyground.plans import geography as G
from skyground.schemas import KNOWN_COUNTRIES, known_countries
from skyground.sources.pages import assemble_pages, missing_pages, void_listings

STAMP = dt.datetime(2024, 1, 2, 3, 30, tzinfo=dt.timezone.utc)
CITY = {"id": 1, "name": "Town", "type": "CITY", "country": "Spain", "countryCode": "ES", "region": "R", "regionCode": "r1", "latitude": 40.6413, "longitude": -3.5, "population": 5000}


def city(**parts):
    return {**CITY, **parts}


def without(*names):
    return {name: part for name, part in CITY.items() if name not in names}


# --- pages --------------------------------------------------------------------
def pages(spark, *rows, schema="listing string, page_offset int, http_status int, payload string"):
    return spark.createDataFrame(
        [(*row[:-1], row[-1] if row[-1] is None else json.dumps({"data": row[-1]})) for row in rows], schema
    )



def values(df):
    rows = df.selectExpr("listing", "page_offset", "pos", "cast(item AS int) AS value").collect()
    return [r.value for r in sorted(rows, key=lambda r: (r.listing, r.page_offset, r.pos))]


def numbers(start, count):
    return list(range(start, start + count))


def test_short_page_ends_the_listing(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 200, numbers(3, 2)), ("a", 6, 200, numbers(5, 3)))
    assert values(assemble_pages(df, page_size=3)) == numbers(0, 5)


def test_empty_page_ends_the_listing(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 200, []), ("a", 6, 200, numbers(5, 3)))
    assert values(assemble_pages(df, page_size=3)) == numbers(0, 3)


def test_offsets_past_the_maximum_do_not_count(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 200, numbers(3, 3)), ("a", 6, 200, numbers(6, 3)))
    assert values(assemble_pages(df, page_size=3, max_offset=6)) == numbers(0, 6)


def test_limit_cuts_within_a_page_and_per_listing(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 200, numbers(3, 3)), ("b", 0, 200, numbers(50, 2)))
    assert values(assemble_pages(df, page_size=3, limit=4)) == [0, 1, 2, 3, 50, 51]


def test_failed_page_voids_its_listing(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 500, None), ("b", 0, 200, numbers(50, 3)), ("b", 3, 200, []))
    assert values(assemble_pages(df, page_size=3)) == [50, 51, 52]


def test_failed_page_past_the_end_is_harmless(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 500, None))
    assert values(assemble_pages(df, page_size=3, limit=3)) == [0, 1, 2]
    df = pages(spark, ("a", 0, 200, numbers(0, 2)), ("a", 3, 403, None))
    assert values(assemble_pages(df, page_size=3)) == [0, 1]


def test_rate_limited_page_is_fetched_again(spark):
    df = pages(spark, ("a", 0, 429, None), ("a", 0, 200, numbers(0, 2)))
    assert values(assemble_pages(df, page_size=3)) == [0, 1]


@pytest.mark.parametrize(
    "rows, reason",
    [
        ([(0, 200, 3), (3, 429, None)], "unanswered"),
        ([(0, 200, 3), (6, 200, 3), (9, 200, 0)], "gap"),
        ([(0, 200, 3), (3, 200, "<html>")], "not_json"),
        ([(3, 200, 2)], "gap"),
        ([(0, 200, 3), (3, 500, None), (6, 200, 1)], "failed"),
    ],
)
def test_listing_that_lacks_a_page_is_void(spark, rows, reason):
    payload = lambda n: n if n is None or isinstance(n, str) else json.dumps({"data": numbers(0, n)})
    schema = "listing string, page_offset int, http_status int, payload string"
    data = [("a", at, status, payload(n)) for at, status, n in rows] + [("b", 0, 200, payload(2))]
    df = spark.createDataFrame(data, schema)
    assert values(assemble_pages(df, page_size=3)) == [0, 1]
    assert [tuple(r) for r in void_listings(df, page_size=3).collect()] == [("a", reason)]


def test_page_that_landed_twice_counts_once(spark):
    df = pages(
        spark,
        ("a", 0, 200, numbers(0, 3)),
        ("a", 0, 200, numbers(0, 3)),
        ("a", 0, 500, None),
        ("a", 3, 429, None),
        ("a", 3, 200, numbers(3, 1)),
        ("a", 3, 429, None),
    )
    assert values(assemble_pages(df, page_size=3)) == numbers(0, 4)
    assert void_listings(df, page_size=3).count() == 0


def test_pages_gather_no_items_in_a_window(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)))
    assert "Window" not in assemble_pages(df, page_size=3)._jdf.queryExecution().executedPlan().toString()


def lacking(df, **options):
    return sorted(tuple(r) for r in missing_pages(df, page_size=3, **options).collect())


def test_listing_without_an_end_is_open(spark):
    df = pages(spark, ("a", 0, 200, numbers(0, 3)), ("a", 3, 200, numbers(3, 3)), ("b", 0, 200, numbers(50, 1)))
    # The trailing page never landed, so three or more items may be missing.
    assert values(assemble_pages(df, page_size=3)) == [50]
    assert [tuple(r) for r in void_listings(df, page_size=3).collect()] == [("a", "open")]
    assert lacking(df) == [("a", 6, "open")]
    # Once it has landed, short or empty, the listing is whole.
    for last in (1, 0):
        whole = df.unionByName(pages(spark, ("a", 6, 200, numbers(6, last))))
        assert values(assemble_pages(whole, page_size=3)) == [*numbers(0, 6 + last), 50]
        assert lacking(whole) == []
    # A bound ends the asking.
    for bound in ({"max_offset": 6}, {"limit": 6}, {"limit": 5}, {"max_offset": 4, "limit": 100}):
        assert values(assemble_pages(df, page_size=3, **bound))[:5] == numbers(0, 5)
        assert void_listings(df, page_size=3, **bound).count() == 0 and lacking(df, **bound) == []
    assert lacking(df, limit=7) == [("a", 6, "open")]


def test_missing_pages_are_what_makes_listings_whole(spark):
    payload = lambda n: n if n is None or isinstance(n, str) else json.dumps({"data": numbers(0, n)})
    rows = [
        # Failed, unanswered and unread pages, one that never landed, and one that nobody knows whether it is there.
        ("a", 0, 200, 3), ("a", 3, 500, None), ("a", 6, 429, None), ("a", 9, 200, "<html>"), ("a", 15, 200, 3),
        # What stands behind the end does not matter, nor how often a page landed.
        ("b", 0, 429, None), ("b", 0, 200, 3), ("b", 3, 200, 2), ("b", 6, 500, None), ("b", 12, 200, 3),
        # The last page failed: whether another follows is not known yet.
        ("c", 0, 200, 3), ("c", 3, 403, None),
        ("d", 6, 200, 0),
    ]
    schema = "listing string, page_offset int, http_status int, payload string"
    df = spark.createDataFrame([(*r[:-1], payload(r[-1])) for r in rows], schema)
    assert lacking(df) == [
        ("a", 3, "failed"), ("a", 6, "unanswered"), ("a", 9, "not_json"), ("a", 12, "gap"), ("a", 18, "open"),
        ("c", 3, "failed"), ("d", 0, "gap"), ("d", 3, "gap"),
    ]
    asked = lambda name: [(name, at) for n, at, _ in lacking(df) if n == name]
    # Asked for and landed, until there is nothing left to ask.
    answers = [(n, at, 200, payload(3 if at < 18 else 1)) for name in "acd" for n, at in asked(name)]
    later = df.unionByName(spark.createDataFrame(answers, schema))
    assert lacking(later) == [("c", 6, "open")]
    done = later.unionByName(spark.createDataFrame([("c", 6, 200, payload(0))], schema))
    assert lacking(done) == [] and void_listings(done, page_size=3).count() == 0
    wanted = spark.createDataFrame([("b",), ("new",), ("new",)], "listing string")
    assert lacking(done, wanted=wanted) == [("new", 0, "open")]
    assert lacking(df.limit(0), wanted=wanted) == [("b", 0, "open"), ("new", 0, "open")]


# --- countries ----------------------------------------------------------------
def country_pages(spark, *codes):
    rows = [
        ("c", at, 200, [{"code": code, "name": f"N{code}", "currencyCodes": ["EUR", "XXX"], "continent": "EU"} for code in codes[at : at + 10]])
        for at in range(0, max(len(codes), 1), 10)
    ]
    return pages(spark, *rows)


def test_countries(spark):
    rows = pages(
        spark,
        ("c", 0, 200, [{"code": "ES", "name": "Spain", "currencyCodes": ["EUR", "X"], "continent": None}, {"code": "AQ", "currencyCodes": []}, {"currencyCodes": None}, {}]),
    )
    table = G.countries_table(G.country_items(rows), utc_timestamp(STAMP))
    got = {(r.country_code, r.country_name, r.currency_code, r.continent, str(r.extraction_date)) for r in table.collect()}
    assert got == {("ES", "Spain", "EUR", None, "2024-01-02"), ("AQ", None, None, None, "2024-01-02"), (None, None, None, None, "2024-01-02")}


def chosen(spark, *codes):
    return [(r.country_code, r.is_match) for r in G.targets(G.country_items(country_pages(spark, *codes))).orderBy("position").collect()]


def test_targets_without_a_listing(spark):
    assert chosen(spark) == [(code, False) for code in KNOWN_COUNTRIES[:10]]


def test_targets_are_filled_to_ten_in_list_order(spark):
    got = chosen(spark, "ZZ", "BR", "ES")
    assert got[:2] == [("BR", True), ("ES", True)]
    assert [code for code, _ in got[2:]] == ["US", "GB", "FR", "DE", "IT", "NL", "JP", "CN"]


def test_more_than_ten_matches_are_kept(spark):
    got = chosen(spark, *KNOWN_COUNTRIES[3:])
    assert got == [(code, True) for code in KNOWN_COUNTRIES[3:]]


def test_all_listed_countries_count(spark):
    got = chosen(spark, *[f"Z{i}" for i in range(15)], "MX")
    assert got[0] == ("MX", True) and len(got) == 10


def test_repeated_code_counts_once(spark):
    assert chosen(spark, "FR", "US", "FR")[:3] == [("FR", True), ("US", True), ("GB", False)]


# --- places -------------------------------------------------------------------
def parse(spark, *items, scope="document", limit=10):
    docs = spark.createDataFrame([("ES", json.dumps({"data": list(items)}))], "country_code string, payload string")
    return P.parse_places(docs, utc_timestamp(STAMP), limit, scope)


def reasons(spark, *items, **options):
    return [r.reject_reason for r in parse(spark, *items, **options).collect()]


def test_place_values(spark):
    row = parse(spark, city(countryCode="XX")).first()
    assert (row.place_id, row.place_name, row.place_type, row.country_code) == (1, "Town", "CITY", "ES")
    assert (row.country_name, row.elevation_meters, row.timezone) == (None, None, None)
    assert (row.region, row.region_code, row.population) == ("R", "r1", 5000)
    # Coordinates are single precision.
    assert (row.latitude, row.longitude) == (40.641300201416016, -3.5)


def test_defaults(spark):
    table = P.enrich_places(P.accepted_places(parse(spark, without("latitude", "longitude", "population"), city(latitude=0, longitude=None))))
    assert len(table.columns) == 17
    rows = table.collect()
    assert [(r.latitude, r.longitude) for r in rows] == [(None, None), (None, None)]
    assert rows[0].population == 0
    assert (rows[0].population_category, rows[0].elevation_category, rows[0].hemisphere) == ("Small", "Small", "Equatorial")
    assert str(rows[0].extraction_date) == "2024-01-02"


@pytest.mark.parametrize(
    "part",
    [{"population": None}, {"population": "5000"}, {"population": []}, {"latitude": None}, {"latitude": "1.5"}, {"longitude": "x"}, {"longitude": [1]}],
)
def test_bad_city_rejects_its_document(spark, part):
    assert reasons(spark, city(), city(**part)) == ["bad_document"] * 2
    assert reasons(spark, city(), city(**part), scope="row") == [None, "bad_item"]
    # Other types are skipped before anything is compared.
    assert reasons(spark, city(), city(type="ADM2", **part)) == [None]
    # So are items past the limit.
    assert reasons(spark, city(), city(**part), limit=1) == [None]


@pytest.mark.parametrize("item", [None, "x", 5, [1]])
def test_item_that_is_no_object_rejects_its_document(spark, item):
    assert reasons(spark, city(), item) == ["bad_document"]


@pytest.mark.parametrize("part", [{"population": 5.5}, {"population": 3_000_000_000}, {"population": True}, {"id": "7"}, {"id": 1.0}])
def test_value_the_table_cannot_hold_rejects_its_row(spark, part):
    assert reasons(spark, city(), city(**part)) == [None, "bad_cast"]


@pytest.mark.parametrize("value", [None, "", 0, False, [], {}])
def test_falsy_longitude(spark, value):
    row = parse(spark, city(longitude=value)).first()
    assert (row.longitude, row.reject_reason) == (None, None)


def test_text_longitude(spark):
    assert parse(spark, city(longitude="12.5")).first().longitude == 12.5


def test_type_is_exact(spark):
    assert reasons(spark, city(type="city"), city(type=None), without("type"), city(type=["CITY"])) == []


def test_limit_comes_before_the_type(spark):
    items = [city(id=i, type="ADM2" if i % 2 else "CITY") for i in range(12)]
    assert [r.place_id for r in parse(spark, *items).collect()] == [0, 2, 4, 6, 8]


def test_scope_is_checked(spark):
    with pytest.raises(ValueError):
        parse(spark, city(), scope="planet")
    # A whole country without a limit needs the marks, not one window.
    with pytest.raises(ValueError):
        parse(spark, city(), scope="country", limit=None)


def documents(spark, *rows):
    """Rows of (country, document, items)."""
    data = [(code, at, items if isinstance(items, str) else json.dumps({"data": items})) for code, at, items in rows]
    return spark.createDataFrame(data, "country_code string, document int, payload string")


def wanted(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "country_code string")


def judged(spark, docs, limit=None, codes=("ES", "FR", "US")):
    rows = G.judged_places(docs, wanted(spark, *codes), utc_timestamp(STAMP), limit).collect()
    return sorted((r.country_code, -1 if r.place_id is None else r.place_id, r.reject_reason) for r in rows)


@pytest.mark.parametrize("spoiler", [city(id=9, population=None), city(id=9, latitude="1.5"), "oops", None, 5])
def test_bad_item_rejects_its_whole_country(spark, spoiler):
    docs = documents(
        spark,
        ("ES", 0, [city(id=1), city(id=2)]),
        ("ES", 1, [city(id=3), spoiler]),
        ("FR", 0, [city(id=4), city(id="x")]),
        ("FR", 1, [city(id=5, type="ADM2", population=None)]),
        ("US", 0, "{bad"),
    )
    bad = [("ES", i, "bad_country") for i in (1, 2, 3)] + [("ES", 9, "bad_country")] * isinstance(spoiler, dict)
    assert judged(spark, docs) == [*bad, ("FR", -1, "bad_cast"), ("FR", 4, None)]
    table = G.places_table(docs, wanted(spark, "ES", "FR"), utc_timestamp(STAMP))
    assert [r.place_id for r in table.collect()] == [4]


def test_first_items_of_a_country_over_its_documents(spark):
    docs = documents(
        spark,
        ("ES", 2, [city(id=i) for i in (20, 21, 22)]),
        ("ES", 1, [city(id=10), city(id=11, type="ADM2"), city(id=12)]),
        ("ES", 0, []),
        ("FR", 7, [city(id=30)]),
    )
    # Five items, one of which is no city.
    assert judged(spark, docs, 5) == [("ES", 10, None), ("ES", 12, None), ("ES", 20, None), ("ES", 21, None), ("FR", 30, None)]
    assert judged(spark, docs, 1) == [("ES", 10, None), ("FR", 30, None)]
    # A bad item counts where it is among the first, and then for all documents.
    late = docs.unionByName(documents(spark, ("ES", 3, ["oops"])))
    assert {r[2] for r in judged(spark, late, 6)} == {None}
    assert judged(spark, late, 7)[0] == ("ES", 10, "bad_country") and judged(spark, late, 7)[-1] == ("FR", 30, None)
    # Documents without an order are taken by their text.
    assert judged(spark, docs.drop("document"), 2) == [("ES", 10, None), ("FR", 30, None)]


def test_places_keep_their_scope_within_the_limit(spark):
    docs = documents(spark, ("ES", 0, [city(id=1), "oops"]), ("ES", 1, [city(id=2)]), ("ES", 2, ["oops"]))
    got = lambda **options: sorted((r.place_id, r.reject_reason) for r in P.parse_places(docs, utc_timestamp(STAMP), **options).collect())
    for limit in (None, 3, 10):
        assert got(scope="document", limit=limit) == [(1, "bad_document"), (2, None)]
    assert got(scope="document", limit=1) == [(1, None)]
    assert got(scope="row", limit=3) == got(scope="row") == [(1, None), (2, None)]


def test_landing_is_scanned_once_for_places_and_rejects(spark, tmp_path):
    docs = documents(spark, ("ES", 0, [city(id=1)]), ("ES", 1, ["oops"]), ("FR", 0, [city(id=4)]))
    docs.write.parquet(f"{tmp_path}/landing")
    landed = spark.read.parquet(f"{tmp_path}/landing")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    seen = G.judged_places(landed, wanted(spark, "ES", "FR"), utc_timestamp(STAMP))
    assert f"{tmp_path}/landing" not in plan(seen)
    marked = plan(P.mark_places(landed, utc_timestamp(STAMP)))
    assert marked.count("Scan parquet") == 1 and "Exchange" not in marked and marked.count("parse_json") <= 1
    # With a limit one shuffle brings the few rows of a country together; tasks cut first.
    limited = plan(G.judged_places(landed, wanted(spark, "ES", "FR"), utc_timestamp(STAMP), 10))
    assert limited.count("Scan parquet") == 1 and "WindowGroupLimit" in limited and "Partial" in limited


def test_place_list_rejects(spark):
    data = [CITY, "oops", {"id": "Q90", "population": 3e9, "latitude": "abc"}, city(id=2, latitude="1.5"), city(id=3, population=None), {}]
    items = assemble_pages(pages(spark, ("p", 0, 200, data)))
    parsed = P.parse_place_list(items, utc_timestamp(STAMP), "listing", "page_offset", "pos")
    kept = P.accepted_place_list(parsed).collect()
    assert [(r.place_id, r.latitude) for r in kept] == [(1, 40.6413), (2, 1.5), (3, 40.6413), (None, None)]
    lost = P.rejected_place_list(parsed, "listing", "pos").collect()
    assert [tuple(r) for r in lost] == [("p", 1, None, None, "bad_item"), ("p", 2, None, None, "bad_cast")]


def test_only_wanted_countries(spark):
    docs = spark.createDataFrame(
        [(code, json.dumps({"data": [CITY]})) for code in ("ES", "ZZ")] + [("US", '{"data":[]}'), ("FR", "{bad")],
        "country_code string, payload string",
    )
    assert [r.country_code for r in G.places_table(docs, known_countries(spark), utc_timestamp(STAMP)).collect()] == ["ES"]


@pytest.mark.parametrize(
    "population, category, elevation",
    [
        (None, "Unknown", "Unknown"), (0, "Small", "Small"), (999, "Small", "Small"), (1000, "Small", "Medium"),
        (99_999, "Small", "Medium"), (100_000, "Medium", "Large"), (499_999, "Medium", "Large"), (500_000, "Large", "Large"),
        (999_999, "Large", "Large"), (1_000_000, "Large", "Very High"), (1_999_999, "Large", "Very High"),
        (2_000_000, "Metropolitan", "Very High"),
    ],
)
def test_categories(spark, population, category, elevation):
    from pyspark.sql import functions as F

    one = parse(spark, CITY).drop("reject_reason").withColumn("population", F.lit(population).cast("int"))
    row = P.enrich_places(one).first()
    assert (row.population_category, row.elevation_category) == (category, elevation)


def test_hemisphere(spark):
    rows = P.enrich_places(P.accepted_places(parse(spark, city(latitude=0.1), city(latitude=-0.1), city(latitude=0)))).collect()
    assert [r.hemisphere for r in rows] == ["Northern", "Southern", "Equatorial"]


def test_general_list(spark):
    rows = [(1, "CITY", 9_999), (2, "CITY", 10_000), (3, "ADM2", 50_000), (4, "CITY", None), (5, "CITY", 20_000), (6, "CITY", 10_000)]
    places = spark.createDataFrame(rows, "place_id int, place_type string, population int")
    assert [r.place_id for r in P.largest_request(places).collect()] == [2, 6, 5]
    assert [r.place_id for r in P.largest_request(places, descending=True, limit=1).collect()] == [5]
    items = assemble_pages(pages(spark, ("p", 0, 200, [CITY])), max_offset=1000, limit=500)
    row = P.parse_place_list(items, utc_timestamp(STAMP)).first()
    assert (row.country_code, row.country_name, row.latitude) == ("ES", "Spain", 40.6413)


def test_nearby_documents(spark):
    docs = spark.createDataFrame(
        [("JFK", json.dumps({"data": [{"id": 1, "name": "A", "countryCode": "US", "latitude": 1, "longitude": 2.5, "population": 9, "distance": 3.25}, {}]})), ("LAX", '{"data":[]}')],
        "airport string, payload string",
    )
    rows = P.accepted_nearby(P.parse_nearby(docs, utc_timestamp(STAMP))).collect()
    assert [tuple(r)[:-1] for r in rows] == [("JFK", "1", "A", "US", 1.0, 2.5, 9, 3.25), ("JFK", *[None] * 7)]


def test_nearby_rejects(spark):
    data = [{"id": "Q90", "population": 3_000_000_000}, {"id": 2, "latitude": "abc"}, {"id": 3, "population": 1.5}, "oops"]
    docs = spark.createDataFrame([("JFK", json.dumps({"data": data}))], "airport string, payload string")
    parsed = P.parse_nearby(docs, utc_timestamp(STAMP))
    kept = P.accepted_nearby(parsed).collect()
    assert ("Q90", 3_000_000_000) in [(r.city_id, r.population) for r in kept]
    lost = [tuple(r) for r in P.rejected_nearby(parsed, "airport").collect()]
    assert ("JFK", "2", None, "bad_cast") in lost and ("JFK", None, None, "bad_item") in lost
    assert len(kept) + len(lost) == 4


def test_country_items_that_are_no_objects(spark):
    items = G.country_items(pages(spark, ("c", 0, 200, [{"code": "ES"}, "oops", 5])))
    assert [r.country_code for r in C.parse_countries(items, utc_timestamp(STAMP)).collect()] == ["ES"]
    lost = C.rejected_countries(items, utc_timestamp(STAMP)).collect()
    assert sorted((r.api_pos, r.raw, r.reject_reason) for r in lost) == [(1, "oops", "bad_item"), (2, "5", "bad_item")]


def test_listed_codes_keep_their_place(spark):
    items = G.country_items(country_pages(spark, *[f"Z{i}" for i in range(12)]))
    assert sorted((r.api_pos, r.country_code) for r in C.listed_codes(items).collect())[11] == (11, "Z11")
