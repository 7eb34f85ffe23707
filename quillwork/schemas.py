"""Explicit schemas of every input; nothing is ever inferred."""

from pyspark.sql import types as T

STRING, INT, LONG, FLOAT, DOUBLE = (
    T.StringType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
)
BOOLEAN, DATE, LOCAL_TIME = T.BooleanType(), T.DateType(), T.TimestampNTZType()
MONEY = T.DecimalType(7, 2)


def _struct(*required: str, **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required)
                         for name, kind in columns.items()])


TEXT = _struct(value=STRING)

# Page views with the hour as a column, and with the hour in the file name.
PAGE_VIEWS = _struct(hour=STRING, language=STRING, title=STRING, views=LONG, bytes=LONG)
PAGE_VIEWS_BY_FILE = _struct(language=STRING, title=STRING, views=LONG, bytes=LONG)

COMMENTS = _struct(
    archived=BOOLEAN, author=STRING, author_flair_css_class=STRING, author_flair_text=STRING,
    body=STRING, controversiality=LONG, created_utc=STRING, distinguished=STRING, downs=LONG,
    edited=STRING, gilded=LONG, id=STRING, link_id=STRING, name=STRING, parent_id=STRING,
    retrieved_on=LONG, score=LONG, score_hidden=BOOLEAN, subreddit=STRING, subreddit_id=STRING,
    ups=LONG,
)

OBSERVATIONS = _struct(
    station=STRING, date=STRING, observation=STRING, value=INT, mflag=STRING, qflag=STRING,
    sflag=STRING, obstime=STRING,
)
DAILY_MAXIMA = _struct(
    station=STRING, date=DATE, latitude=FLOAT, longitude=FLOAT, elevation=FLOAT, tmax=FLOAT
)

ACCESS_LOG = _struct(host=STRING, id=STRING, bytes=LONG, date_time=LOCAL_TIME, r_path=STRING)

AMENITIES = _struct(
    "amenid", "amenity", amenid=STRING, lat=DOUBLE, lon=DOUBLE, ts=LOCAL_TIME, amenity=STRING, amname=STRING,
    tags=T.MapType(STRING, STRING),
)


def amenities_with_tags(names: list[str]) -> T.StructType:
    """Amenities whose tags are a declared struct of text fields instead of an open map."""
    tags = _struct(**dict.fromkeys(names, STRING))
    return T.StructType([*AMENITIES.fields[:-1], T.StructField("tags", tags)])


CUSTOMERS = _struct(
    "custid", custid=STRING, custname=STRING, street=STRING, city=STRING, province=STRING, postalcode=STRING
)
PAYMENT_METHODS = _struct("pmid", pmid=STRING, custid=STRING, number=STRING, expdate=STRING, mtype=STRING)
PURCHASES = _struct(
    "purchid", purchid=STRING, custid=STRING, pmid=STRING, amenid=STRING, pdate=DATE, amount=MONEY
)
# The partitioned twin keeps pdate in the directory name.
PURCHASES_BY_DAY = _struct(
    purchid=STRING, custid=STRING, pmid=STRING, amenid=STRING, amount=MONEY
)
POSTAL_PREFIXES = _struct(city=STRING, pcprefix=STRING)

SALES = _struct(date=DATE, store=STRING, sales=DOUBLE, staff=DOUBLE)
HOLIDAYS = _struct(date=DATE, holiday=STRING)

COLOURS_REQUIRED = ["R", "G", "B", "word", "confidence"]
COLOURS = _struct(*COLOURS_REQUIRED, R=INT, G=INT, B=INT, word=STRING, confidence=STRING)

# Columns the owner of each table declares: unique key, required columns, references.
DECLARED_KEYS = {
    "amenities": {"key": ["amenid"], "required": ["amenity"], "references": {}},
    "customers": {"key": ["custid"], "required": [], "references": {}},
    "paymentmethods": {
        "key": ["pmid"],
        "required": [],
        "references": {"custid": ("customers", "custid")},
    },
    "purchases": {
        "key": ["purchid"],
        "required": [],
        "references": {
            "custid": ("customers", "custid"),
            "pmid": ("paymentmethods", "pmid"),
            "amenid": ("amenities", "amenid"),
        },
    },
}

# The test tables.
TEST_TABLES = {
    "region": _struct(r_regionkey=INT, r_name=STRING),
    "nation": _struct(n_nationkey=INT, n_name=STRING, n_regionkey=INT),
    "customer": _struct(
        c_custkey=LONG, c_name=STRING, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=STRING
    ),
    "supplier": _struct(s_suppkey=LONG, s_name=STRING, s_nationkey=INT, s_acctbal=DOUBLE),
    "part": _struct(
        p_partkey=LONG, p_name=STRING, p_brand=STRING, p_type=STRING, p_size=INT,
        p_retailprice=DOUBLE,
    ),
    "orders": _struct(
        o_orderkey=LONG, o_custkey=LONG, o_orderstatus=STRING, o_totalprice=DOUBLE,
        o_orderdate=LOCAL_TIME, o_orderpriority=STRING,
    ),
    "lineitem": _struct(
        l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=INT, l_quantity=DOUBLE,
        l_extendedprice=DOUBLE, l_discount=DOUBLE, l_tax=DOUBLE, l_returnflag=STRING,
        l_linestatus=STRING, l_shipdate=LOCAL_TIME,
    ),
    "events": _struct(
        event_id=LONG, ts=LOCAL_TIME, user_id=LONG, event_type=STRING, value=DOUBLE, props=STRING
    ),
    "documents": _struct(doc_id=LONG, text=STRING, lang=STRING, source=STRING, n_chars=LONG),
    "embeddings": _struct(vec_id=LONG, embedding=T.ArrayType(FLOAT), label=INT),
    "pages": _struct(page_id=LONG, url=STRING, html=STRING),
    "benchmark": _struct(item_id=LONG, text=STRING),
    "labels": _struct(doc_id=LONG, quality=INT, toxic=INT),
    "conversations": _struct(conv_id=LONG, turn=LONG, role=STRING, text=STRING),
}
