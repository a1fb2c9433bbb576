"""Golden pairs for the scalar functions."""

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import clock, locale, models, money, text, urls

HOST = "https://www.walmart.com"

ONE_ARG = [
    (money.us_price, "Now $238.00", "$238.00"),
    (money.us_price, "no price", None),
    (money.repair_price, "$1,797 99", "$1797.99"),
    (money.repair_price, "$238 00", "$238.00"),
    (money.repair_price, "$238.00", "$238.00"),
    (lambda c: money.repair_price(c, loose=True), "$238.00", "$2.38"),
    (money.repair_price, "  a \n b ", "a b"),
    (lambda c: money.price_number(c).cast("string"), "$1,299.99 today", "1299.99"),
    (money.savings_amount, "Save $1,200", "$1,200"),
    (text.count_suffix, "100+", 100),
    (text.count_suffix, "10k", 10000),
    (text.count_suffix, "1,000+", 1000),
    (text.count_suffix, "2.01k", 2009),
    (text.count_suffix, "none", None),
    (text.purchase_count, "10K+ bought in past month", "10,000"),
    (text.purchase_count, "300+ bought in past week", "300"),
    (lambda c: text.purchase_count(c, k_anywhere=True), "300+ bought in past week", "300,000"),
    (text.first_int, "4 free offers from Apple", "4"),
    (text.first_int, "only 1 left", "1"),
    (lambda c: text.review_count(c, "suffix"), "248 reviews", "248"),
    (lambda c: text.review_count(c, "suffix"), "1,123 reviews", "1123"),
    (lambda c: text.review_count(c, "suffix"), "16.4k reviews", "16400"),
    (lambda c: text.review_count(c, "suffix"), "1 review", "1"),
    (lambda c: text.review_count(c, "paren"), "(1,234 reviews)", "1234"),
    (lambda c: text.review_count(c, "plain"), "1,484 ratings", "1,484"),
    (text.int_text, "1,123", 1123),
    (text.int_text, "20", 20),
    (text.int_text, "n/a", None),
    (text.stars_total, "5star:142, 4star:14, 3star:7, 2star:2, 1star:4", 169),
    (text.stars_total, "5stars:231 4stars:19 3stars:2 2stars:1 1star:8", 261),
    (text.stars_total, "nothing", None),
    (text.rating, "4.4 out of 5 stars", "4.4"),
    (lambda c: text.rating(c, "first"), "4.4 out of 5 stars", "4.4"),
    (lambda c: text.rating(c, "strict"), "4.7", "4.7"),
    (lambda c: text.rating(c, "strict"), "4.7 stars", None),
    (text.clean_rank, "#8,565 in Electronics (See Top 100 in Electronics)", "#8,565 in Electronics"),
    (text.rank_int, "#12", 12),
    (
        lambda c: text.slice_between(c, "Prime members get", "Join Prime"),
        "x Prime members get FREE delivery Join Prime now",
        "Prime members get FREE delivery",
    ),
    (lambda c: text.slice_between(c, "Prime members get", "Join Prime"), "x", None),
    (lambda c: text.screen_size(c, "inch"), "Screen size: 65 in", "65 inches"),
    (lambda c: text.screen_size(c, "inch"), "64.5 in", "64.5 inches"),
    (lambda c: text.screen_size(c, "lower"), "32 Inches", "32 inches"),
    (lambda c: text.screen_size(c, "class"), "svg65 inches class", "65 inches"),
    (text.kwh, "286 kilowatt hours", "286"),
    (text.kwh, "unknown", "unknown"),
    (text.recommend, "91%", "91% would recommend to a friend"),
    (
        text.order_discounts,
        "Price when purchased online, Reduced price",
        "Reduced price, Price when purchased online",
    ),
    (text.order_discounts, "Clearance", "Clearance"),
    (text.clean_markup, "Save $50<sup class='c'>99</sup><br/>now  <b>only</b>", "Save $50.99 now only"),
    (urls.product_code, "https://www.amazon.com/x/dp/B0F19KLHG3/ref", "B0F19KLHG3"),
    (urls.product_code, "https://www.amazon.com/x", "https://www.amazon.com/x"),
    (lambda c: urls.normalize_url(c, HOST), "/ip/A-B/123?x=1", HOST + "/ip/A-B/123"),
    (
        lambda c: urls.normalize_url(c, HOST),
        "/sp/track?bt=1&rd=https%3A%2F%2Fwww.walmart.com%2Fip%2FTV%2F55%3Fa%3Db&z=2",
        HOST + "/ip/TV/55",
    ),
    (lambda c: urls.normalize_url(c, HOST), HOST + "/ip/A/1?q=2", HOST + "/ip/A/1"),
    (lambda c: urls.normalize_url(c, HOST), "https://x.example/a?b", "https://x.example/a?b"),
    (lambda c: urls.absolute_url(c, HOST), "/p/1", HOST + "/p/1"),
    (lambda c: urls.absolute_url(c, HOST), "p/1", "p/1"),
    (lambda c: urls.absolute_url(c, HOST, unless_http=True), "p/1", HOST + "p/1"),
    (models.model_from_name, 'SANSUI 32" 1920 x 1080 LED Bluetooth/Wi-Fi Smart TV , S32VAFW', "S32VAFW"),
    (
        models.model_from_name,
        "Hisense 85-Inch Class QD6 Series QLED Google Smart TV (85QD6N) - QLED, Dolby Vision, Voice Remote",
        "85QD6N",
    ),
    (models.model_from_name, 'SAMSUNG 65" 4K, Slim Design Sound Lite UN65DU8000', "UN65DU8000"),
    (models.model_from_name, 'SAMSUNG 55" 4K, Slim Design Sound Lite UN55DU8000', "UN55DU8000"),
    (models.is_invalid_model, "4K UHD", True),
    (models.is_invalid_model, "120Hz", True),
    (models.is_invalid_model, "3,840 x 2,160", True),
    (models.is_invalid_model, "480p; 720p", True),
    (models.is_invalid_model, "4K (2160p)", True),
    (models.is_invalid_model, None, True),
    (models.is_invalid_model, "UN65DU8000", False),
    (clock.short_date, "2024-11-25 00:00:00", "Nov 25"),
    (clock.short_date, "unknown date text", "unknown date text"),
    (clock.date_part, "2024-11-25 00:00:00", "2024-11-25"),
    (lambda c: clock.batch_time(c).cast("string"), "20251108_143000", "2025-11-08 14:30:00"),
    (lambda c: clock.batch_time(c).cast("string"), "1762612200", "2025-11-08 14:30:00"),
    (lambda c: clock.crawl_seconds(c), "202511081430001234", 1762612200),
    (lambda c: clock.week_label(c.cast("timestamp")), "2024-12-31 10:00:00", "w1"),
    (lambda c: clock.iso_year(c.cast("timestamp")), "2024-12-31 10:00:00", 2025),
    (lambda c: clock.strdatetime(c.cast("timestamp")), "2025-11-08 14:30:00.123456", "202511081430001234"),
    (
        lambda c: clock.strdatetime(c.cast("timestamp"), fraction=False),
        "2025-11-08 14:30:00.123456",
        "202511081430000000",
    ),
    (money.money, "1234567.00", "1,234,567"),
    (money.money, "1234.5", "1,234.50"),
    (lambda c: locale.in_stock(c, "it"), "Attualmente non disponibile", False),
    (lambda c: locale.in_stock(c, "de"), "Auf Lager", True),
    (lambda c: locale.in_stock(c, "fr"), None, True),
    (locale.page_in_stock, "<b>Sold Out</b>", False),
    (lambda c: locale.strip_label(c, "ships", "it"), "Fulfilled by Amazon", "Amazon"),
    (lambda c: locale.strip_label(c, "ships", "it"), "Spedito da", None),
    (lambda c: locale.strip_label(c, "sold", "de"), "Verkauft von Shop X", "Shop X"),
    (lambda c: locale.strip_label(c, "ships", "de"), "x Versand durch Amazon EU", "Amazon"),
    (lambda c: locale.strip_label(c, "sold", "fr"), "Boutique", "Boutique"),
]

PRICES = [
    ("it", "61,84", "61.84"), ("it", "1.234,56 €", "1234.56"), ("it", "294.", "294.00"),
    ("it", "was € 10", None), ("it", "60000", None), ("it", "60.000,00", "60000.00"), ("it", "0,50", "0.50"),
    ("de", "1299", "12.99"), ("de", "1.299,99", "1299.99"), ("de", "0999", "999.00"), ("de", "12 Stück", None),
    ("fr", "1 299,99", "1299.99"), ("fr", "1 299,99 €", "1299.99"), ("fr", "Achetez d'occasion 10,00 €", None),
    ("es", "1.299,99 €", "1299.99"), ("es", "165", None), ("es", "165,00€", "165.00"), ("es", "9,99€", None),
    ("in", "₹1,23,456.00", "123456.00"), ("in", "₹ 999", "999.00"),
    ("nl", "1.299,99", "1299.99"), ("gb", "£1,299.00", "1299.00"), ("usa", "Now $1,299.50", "1299.50"),
    ("usa", "1299", None), ("pl", "899,00 zł", "899.00"), ("pl", "1 299 PLN", "1299.00"), ("pl", "zł 899", "899.00"),
    ("jp", "¥12,800", "12800.00"), ("jp", "¥12,80", None), ("in_grouped", "₹1,23,456.00", "123456.00"),
    ("en_grouped", "$1,299.00", "1299.00"), ("en_grouped", "$12,99", None), ("es_alt", "12,50", "12.50"),
    ("en_ranged", "£1,299.00", "1299.00"), ("en_ranged", "was £9", None), ("en_ranged", "$4.99", None), ("en_ranged", "12999", None),
]

IP = "https://www.walmart.com/ip/"
# (path, coded rule, written examples)
URL_MODELS = [
    ("TCL-43-Class-S3-43S310R-1080p-FHD-LED-Smart-TV-with-Roku-TV-New/3883035649", "43S310R", "43S310R"),
    ("iLive-18-5-LED-TV-with-DVD-Player-ITDE1988B/414649405", "ITDE1988B", "ITDE1988B"),
    ("Supersonic-SC-1926SDVD-19-inch-AC-DC-LED-SMART-TV-Built-in-DVD-Powered-by-VIDAA-LED/14071706329",
     "1926SDVD-19", "1926SDVD"),
    ("VIZIO-50-Class-4K-UHD-LED-HDR-Smart-TV-New-V4K50M-08/5195359734", "V4K50M-08", "V4K50M-08"),
    ("onn-55-Class-4K-UHD-2160P-LED-Roku-Smart-Television-HDR-100012586/201216466", "100012586", "100012586"),
    ("55UA7500ZUA-AUS/14356152032", "55UA7500ZUA", "55UA7500ZUA"),
    ("Sony-65-Class-X77L-4K-Ultra-HD-LED-Smart-Google-TV-KD65X77L-2023-Model/2727006920",
     "KD65X77L-2023", "KD65X77L"),
    ("VIZIO-65-Class-Quantum-Pro-4K-QLED-HDR-120Hz-Smart-TV-NEW-VQP65C-84/1110721814", "VQP65C-84", "VQP65C-84"),
    ("Hisense-40-Inch-Class-A4-Series-FHD-1080p-Google-Smart-TV-40A4K-DTS-Virtual-X-Game/3405717257",
     "1080p", "40A4K"),
    ("Element-43-Class-4K-UHD-2160p-LED-XUMO-Smart-Television-HDR-E550AE43C-G/5558619060",
     "E550AE43C", "E550AE43C-G"),
    ("VIZIO-50-Class-Quantum-4K-QLED-HDR-Smart-TV-NEW-VQD50M-0809/7766121878", "VQD50M-0809", "VQD50M-0809"),
    ("Hisense-85-Class-QD6-Series-QLED-4K-UHD-Smart-Google-TV/13110405902", None, None),
    ("65-UHD-2160p-120Hz-4K/5387137037", "2160p", None),
    ("Samsung-55-in-2160p-UHD-Smart-TV-With-TM2360E-Remote-Control/5387137036", "TM2360E", None),
    ("55UA7500ZUA-AUS", "55UA7500ZUA", "55UA7500ZUA"),
]


def _evaluate(spark, pairs):
    """One Spark job per list: every pair is a column."""
    row = spark.range(1).select(
        *[fn(F.lit(value).cast("string")).alias(f"c{i}") for i, (fn, value) in enumerate(pairs)]
    ).first()
    return list(row)


def test_one_argument_functions(spark):
    got = _evaluate(spark, [(f, v) for f, v, _ in ONE_ARG])
    wrong = [(i, v, g, e) for i, ((_, v, e), g) in enumerate(zip(ONE_ARG, got)) if g != e]
    assert not wrong


def test_locale_prices(spark):
    got = _evaluate(
        spark, [(lambda c, cc=cc: locale.parse_price(c, cc).cast("string"), v) for cc, v, _ in PRICES]
    )
    wrong = [(cc, v, g, e) for (cc, v, e), g in zip(PRICES, got) if g != e]
    assert not wrong


def test_models_from_urls(spark):
    coded = _evaluate(spark, [(models.model_from_url, IP + p) for p, _, _ in URL_MODELS])
    assert [(p, g, e) for (p, e, _), g in zip(URL_MODELS, coded) if g != e] == []
    strict = _evaluate(spark, [(lambda c: models.model_from_url(c, strict=True), IP + p) for p, _, _ in URL_MODELS])
    assert [(p, g, e) for (p, _, e), g in zip(URL_MODELS, strict) if g != e] == []


def test_two_argument_functions(spark):
    df = spark.range(1).select(
        money.savings(F.lit("$119.99"), F.lit("$149.99")).alias("s"),
        money.savings(F.lit("$149.99"), F.lit("$119.99")).alias("neg"),
        money.savings_ok(F.lit("$100"), F.lit("$130"), F.lit("$30.00")).alias("ok"),
        money.savings_ok(F.lit("$100"), F.lit("$130"), F.lit("$20")).alias("bad"),
        money.savings_ok(F.lit(None).cast("string"), F.lit("$130"), F.lit("$20")).alias("skip"),
        text.stars_from_pct(F.lit(2449), F.array(F.lit(73), F.lit(13), F.lit(None), F.lit(3), F.lit(7))).alias("pct"),
        text.star_count(F.lit("71% (489)"), F.lit(""), F.lit(10)).alias("c1"),
        text.star_count(F.lit("71%"), F.lit("489 ratings are rated 5 stars"), F.lit(10)).alias("c2"),
        text.star_count(F.lit("50%"), F.lit("5 stars"), F.lit(5)).alias("c3"),
        text.stars_text(F.array(F.lit(9), F.lit(None), F.lit(0)), "comma").alias("t1"),
        text.stars_text(F.array(F.lit(9), F.lit(1)), "space").alias("t2"),
        text.classify_badges(
            F.array(*[F.lit(x) for x in [
                "100+ bought since yesterday", "In 50+ people's carts", "Rollback", "Best seller", "Popular pick",
            ]])
        ).alias("b"),
        text.sku_status(F.lit("x"), F.lit("y")).alias("st1"),
        text.sku_status(F.lit(""), F.lit("y")).alias("st2"),
        text.join_parts(F.lit("a"), F.lit(""), F.lit("b")).alias("j"),
        text.pad(F.array(F.lit("x"), F.lit("—")), 4).alias("p"),
        text.promo_label(F.lit("Big"), F.lit("sale"), F.lit("")).alias("pl1"),
        text.promo_label(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("a \n\n b\nc")).alias("pl2"),
        models.model(F.lit("1080p"), F.lit("(SC-1311)"), F.lit(""), F.lit("")).alias("m1"),
        models.model(F.lit("4K UHD"), F.lit(None).cast("string"), F.lit("x"), F.lit("TV , S32VAFW")).alias("m2"),
        locale.parse_price(locale.whole_and_fraction(F.lit("61,"), F.lit("84")), "it").cast("string").alias("wf"),
        money.outcome(F.lit(None).cast("int"), F.lit("t")).alias("o"),
        money.null_if_no_seller(F.lit(5), F.lit(" "), F.lit(None).cast("string")).alias("ns"),
        money.range_gate(F.lit(60000)).alias("rg"),
        text.first_of(F.lit(" "), F.lit("b ")).alias("fo"),
        text.allow(F.lit("x"), ["y"]).alias("al"),
        text.allow_all_of(F.lit("Amazon's Top Choice"), ["Amazon's", "Choice"]).alias("aa"),
    ).first()
    assert df.s == "$30.00" and df.neg is None
    assert df.ok and not df.bad and df.skip
    assert df.pct == [1787, 318, 0, 73, 171]
    assert (df.c1, df.c2, df.c3) == (489, 489, 2)
    assert df.t1 == "5star:9, 3star:0" and df.t2 == "5stars:9 4stars:1 3stars:0 2stars:0 1star:0"
    assert tuple(df.b) == (100, 50, "Best seller, Popular pick", "Rollback")
    assert (df.st1, df.st2) == ("Rollback", "Sponsored")
    assert df.j == "a, b" and df.p == ["x", None, None, None]
    assert (df.pl1, df.pl2) == ("Big sale", "a b")
    assert (df.m1, df.m2) == ("SC-1311", "S32VAFW")
    assert df.wf == "61.84" and df.o == "no price" and df.ns is None and df.rg is None
    assert df.fo == "b" and df.al is None and df.aa == "Amazon's Top Choice"


@pytest.mark.parametrize("bad", ["nope"])
def test_unknown_style_is_an_error(bad):
    with pytest.raises(ValueError):
        text.rating("c", bad)
