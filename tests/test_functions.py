"""Golden rows for the scalar operators, including the reference's defects (2.J)."""

from pyspark.sql import functions as F

from conftest import one
from gatewatch.functions import classify as C
from gatewatch.functions import masking as M
from gatewatch.functions import params as P
from gatewatch.functions import text as T
from gatewatch.functions import xml as X


def test_md5_rfc_vectors(spark):
    cases = {
        "": "D41D8CD98F00B204E9800998ECF8427E",
        "a": "0CC175B9C0F1B6A831C399E269772661",
        "abc": "900150983CD24FB0D6963F7D28E17F72",
        "message digest": "F96B697D7CB7938D525A2F31AAF161D0",
        "abcdefghijklmnopqrstuvwxyz": "C3FCD3D76192E4007DFB496CCA67E13B",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "D174AB98D277D9F5A5611C2C9F419D9F",
    }
    for s, h in cases.items():
        assert one(spark, T.md5_upper(F.lit(s))) == h


def test_md5_whole_utf8_string(spark):
    # 2.J-9: the whole UTF-8 string is hashed, not its first length() bytes
    import hashlib
    assert one(spark, T.md5_upper(F.lit("中国"))) == hashlib.md5("中国".encode()).hexdigest().upper()


def test_unescape(spark):
    assert one(spark, T.unescape(F.lit("%u4E2D%u56FD"))) == "中国"
    assert one(spark, T.unescape(F.lit("a%41b"))) == "aAb"
    assert one(spark, T.unescape(F.lit('q"\\x'))) == 'q"\\x'


def test_url_decode(spark):
    assert one(spark, T.url_decode(F.lit("a+b%20c%E4%B8%AD"))) == "a b c中"
    assert one(spark, T.url_decode(F.lit("%zz"))) is None


def test_cookie_value_after_first_equals(spark):
    # 2.J-2: the value keeps everything after the first '='
    c = F.lit("JSESSIONID=ab=cd; userId4logCookie=u%20x")
    assert one(spark, T.session_id(c)) == "ab=cd"
    assert one(spark, T.user_id(c)) == "u x"


def test_cookie_last_wins_and_missing(spark):
    c = F.lit("JSESSIONID=a;JSESSIONID=b;JSESSIONID=")
    assert one(spark, T.session_id(c)) == "b"
    assert one(spark, T.session_id(F.lit("x=1"))) is None
    pairs = one(spark, T.cookie_pairs(F.lit(" k = v ;j=%u4E2D;e=")))
    assert [(p["k"], p["v"]) for p in pairs] == [("k", " v "), ("j", "中")]


def test_mask_phone_guards(spark):
    # 2.J-3/4/5: no partial masking of longer runs; match at index 0 and at the end
    phone = "13812345678"
    h = one(spark, T.md5_upper(F.lit(phone)))
    assert one(spark, M.mask_phones(F.lit(phone))) == h
    assert one(spark, M.mask_phones(F.lit("x" + phone))) == "x" + h
    assert one(spark, M.mask_phones(F.lit("1" + phone))) == "1" + phone
    # 2.J-7: '14|' is not a phone prefix
    assert one(spark, M.mask_phones(F.lit("14|12345678"))) == "14|12345678"


def test_mask_ids_before_phones(spark):
    # 2.J-6: an 11-digit run inside an id is not taken for a phone
    id18 = "110101199003071234"
    assert id18[6:17] != "" 
    masked = one(spark, M.mask_pii(F.lit(f"id={id18};tel=13912345678")))
    assert masked == "id=" + one(spark, T.md5_upper(F.lit(id18))) + ";tel=" + one(
        spark, T.md5_upper(F.lit("13912345678")))
    x = "11010119900307123X"
    assert one(spark, M.mask_ids(F.lit(x))) == one(spark, T.md5_upper(F.lit(x)))


def test_strip_whitespace(spark):
    assert one(spark, T.strip_whitespace(F.lit(" a\tb\r\nc\x00 "))) == "abc"


def test_classify_priority(spark):
    pats = {"nq": ["/s.*"], "nb": ["/b.*"], "iq": ["/s/i.*"], "ib": ["/b/i.*"]}
    r = one(spark, C.classify_request(F.lit("/s/i/x"), pats))
    assert (r["flight_type"], r["behavior_type"]) == ("International", "Query")
    r = one(spark, C.classify_request(F.lit("/none"), pats))
    assert (r["flight_type"], r["behavior_type"]) == ("Other", "Other")
    # whole-string match, not substring
    r = one(spark, C.classify_request(F.lit("x/s"), pats))
    assert r["behavior_type"] == "Other"


def test_travel_type(spark):
    assert one(spark, C.travel_type(F.lit("http://h/p?a=2024-01-01"))) == "OneWay"
    assert one(spark, C.travel_type(F.lit("http://h/p?a=2024-01-01&b=2024-02-00"))) == "RoundTrip"
    assert one(spark, C.travel_type(F.lit("http://h/p?a=2024-13-01"))) == "Unknown"
    assert one(spark, C.travel_type(F.lit("http://h/p"))) == "Unknown"
    assert one(spark, C.travel_type(F.lit("http://h/p?a=2024-01-01x&c=1"))) == "Unknown"


def test_get_params_split_semantics(spark):
    pairs = one(spark, P.get_params(F.lit("/p?a=1&b=&c=x=y&a=2&d")))
    assert [(p["k"], p["v"]) for p in pairs] == [("a", "1"), ("c", "x"), ("a", "2")]
    assert one(spark, P.param(P.get_params(F.lit("/p?a=1&a=2")), "a")) == "2"
    assert one(spark, P.get_params(F.lit("/p"))) is None


def test_form_params_decoded(spark):
    assert one(spark, P.param(P.form_params(F.lit("q=%7B%22a%22%3A1%7D&r=x+y")), "r")) == "x y"


def test_json_extraction_literal(spark):
    doc = F.lit('{"depcity":"CAN", "arrcity":"WUH", "flightdate":"20180220", "adultnum":"1", "n": 3}')
    assert one(spark, P.json_field(doc, "$.flightdate")) == "20180220"
    # 2.J-14: a non-string value is returned as text
    assert one(spark, P.json_field(doc, "$.n")) == "3"
    assert one(spark, P.json_field(F.lit("not json"), "$.a")) is None
    assert one(spark, P.json_field(doc, F.lit("$.arrcity"))) == "WUH"


def test_json_list_and_map(spark):
    assert one(spark, P.json_list(F.lit('{"a":["x","y"]}'), "$.a")) == ["x", "y"]
    assert one(spark, P.json_list(F.lit('{"a":"x"}'), "$.a")) == ["x"]
    assert one(spark, P.json_to_map(F.lit("oops"))) == {}
    assert one(spark, P.strip_brackets(F.lit('[{"a":1}]'))) == '{"a":1}'
    assert one(spark, P.strip_brackets(F.lit(""))) is None


def test_xml_reads_and_guard(spark):
    xml = F.lit("<r><page><SEGTYPE>R</SEGTYPE><n>a</n><n>b</n></page></r>")
    assert one(spark, X.xml_travel_type(xml)) == "RoundTrip"
    assert one(spark, X.xml_travel_type(F.lit("<r><SEGTYPE>S</SEGTYPE></r>"))) == "OneWay"
    assert one(spark, X.xml_nodes(xml, "//n/text()")) == ["a", "b"]
    # malformed XML does not fail the task
    assert one(spark, X.xml_text(F.lit("<r><a>x</r>"), "//a/text()")) is None
    assert one(spark, X.xml_text(F.lit("plain text"), "//a/text()")) is None
    assert one(spark, X.from_page(F.lit("<x/>"))) is None
    assert one(spark, X.contact_name(F.lit("Li|Wang"))) == "Li"
    assert one(spark, X.contact_phone(F.lit("139/ext"))) == "139"
