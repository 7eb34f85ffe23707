from decimal import Decimal

import pytest

from quillwork import schemas
from quillwork.operators import warehouse
from quillwork.sources import readers


@pytest.fixture
def star(spark):
    table = spark.createDataFrame
    return {
        "customers": table(
            [("c1", "BC", "V5K0A1"), ("c2", "BC", "V2A1B1"), ("c3", "ON", "M5V2T6"), ("c4", None, None)],
            "custid string, province string, postalcode string"),
        "prefixes": table([("Vancouver", "V5K"), ("Burnaby", "V5K"), ("Burnaby", "V5J")],
                          "city string, pcprefix string"),
        "methods": table([("p1", "c3", "credit"), ("p2", "c3", "debit"), ("p3", "c1", "credit")],
                         "pmid string, custid string, mtype string"),
        "amenities": table(
            [("a1", "restaurant", {"cuisine": "Sushi;ramen"}), ("a2", "restaurant", {}),
             ("a3", "cafe", {"cuisine": "sushi"})],
            "amenid string, amenity string, tags map<string,string>"),
        "purchases": table(
            [("c3", "p1", "a1", Decimal("10.00")), ("c3", "p1", "a2", Decimal("20.00")),
             ("c3", "p2", "a3", Decimal("5.00")), ("c1", "p3", "a1", Decimal("30.00")),
             ("c2", "p3", "a1", Decimal("8.00")), ("c4", "p3", "a2", Decimal("1.00"))],
            "custid string, pmid string, amenid string, amount decimal(7,2)"),
    }


def test_average_by_method(star):
    out = warehouse.average_by_method(star["purchases"], star["methods"], star["customers"])
    assert sorted(map(tuple, out.collect())) == [("credit", 15.0), ("debit", 5.0)]


def test_area_view_keeps_one_row_per_customer(star):
    out = warehouse.area_view(star["customers"], star["prefixes"])
    assert sorted(map(tuple, out.collect())) == [("c1", 1), ("c2", 0), ("c3", 0), ("c4", 0)]


def test_segments(star):
    area = warehouse.area_view(star["customers"], star["prefixes"])
    out = warehouse.visitor_segments(star["purchases"], area, star["customers"])
    assert sorted(map(tuple, out.collect())) == [
        (False, False, 4, 9.0, 7.5), (False, True, 1, 30.0, 30.0), (True, False, 1, 8.0, 8.0)
    ]


@pytest.mark.parametrize("form", ["map", "json", "variant", "struct"])
def test_tagged_amenities(star, form):
    amenities = star["amenities"]
    as_json = "to_json(tags)"
    if form == "json":
        amenities = amenities.selectExpr("amenid", "amenity", f"{as_json} tags")
    elif form == "variant":
        amenities = amenities.selectExpr("amenid", "amenity", f"parse_json({as_json}) tags")
    elif form == "struct":
        amenities = amenities.selectExpr("amenid", "amenity",
                                         "named_struct('cuisine', tags['cuisine']) tags")
    area = warehouse.area_view(star["customers"], star["prefixes"])
    out = warehouse.average_at_tagged(star["purchases"], amenities, area)
    assert sorted(map(tuple, out.collect())) == [(0, 9.0), (1, 30.0)]
    assert warehouse.amenities_with_tag(amenities, "missing", "%x%", "cafe").count() == 0


def test_declared_tag_struct(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"amenid": "a1", "amenity": "cafe", "tags": {"cuisine": "Sushi", "unlisted": "x"}}\n{broken\n')
    schema = schemas.amenities_with_tags(["brand", "cuisine"])
    amenities = readers.json_lines(spark, str(tmp_path), schema, "DROPMALFORMED")
    assert warehouse.amenities_with_tag(amenities, "cuisine", "%sushi%", "cafe").count() == 1
    assert amenities.filter("tags.brand is null").count() == 1
