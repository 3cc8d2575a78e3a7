"""Language identification: an interface, a stop-word detector, and the rules over predictions.

A prediction is map<language, struct<probability, proportion>>.  The detector here scores stop
words in expressions; any other that gives the same map can take its place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.text import let

#: Thresholds of the rules.
MULTIPLE = (0.9, 0.05)
STORED = (0.05, 0.005)
SINGLE = (0.9, 0.9)
ENGLISH_PARAGRAPH = (0.7, 0.25)

STOP_WORDS = {
    "deu": ("der", "die", "das", "und", "von", "den", "ist", "ein"),
    "eng": ("the", "and", "of", "to", "in", "is", "that", "for"),
    "fra": ("le", "la", "les", "des", "et", "que", "de", "un"),
    "spa": ("el", "los", "las", "que", "y", "en", "del", "por"),
}

# ISO 639-3 codes of sites and the codes their detector gives.
DETECTOR_CODES = {
    "eng": "en", "sqi": "sq", "bos": "bs", "ell": "el", "mkd": "mk", "srp": "sr", "ukr": "uk", "hye": "hy", "kat": "ka", "rus": "ru", "uzb": "uz", "ben": "bn",
    "pus": "ps", "urd": "ur", "mya": "my", "ind": "id", "khm": "km", "kor": "ko", "lao": "lo", "tha": "th", "vie": "vi", "amh": "am", "bam": "fr", "fra": "fr",
    "hau": "ha", "por": "pt", "sna": "sn", "som": "so", "swh": "sw", "fas": "fa", "kur": "ku", "tur": "tr", "hat": "ht", "spa": "es",
}

# ISO 639-1 codes and their ISO 639-3 codes.
TWO_LETTERS = dict(
    pair.split(":")
    for pair in (
        "aa:aar ab:abk ae:ave af:afr ak:aka am:amh an:arg ar:ara as:asm av:ava ay:aym az:aze ba:bak be:bel bg:bul bi:bis bm:bam bn:ben bo:bod br:bre bs:bos "
        "ca:cat ce:che ch:cha co:cos cr:cre cs:ces cu:chu cv:chv cy:cym da:dan de:deu dv:div dz:dzo ee:ewe el:ell en:eng eo:epo es:spa et:est eu:eus fa:fas "
        "ff:ful fi:fin fj:fij fo:fao fr:fra fy:fry ga:gle gd:gla gl:glg gn:grn gu:guj gv:glv ha:hau he:heb hi:hin ho:hmo hr:hrv ht:hat hu:hun hy:hye hz:her "
        "ia:ina id:ind ie:ile ig:ibo ii:iii ik:ipk io:ido is:isl it:ita iu:iku ja:jpn jv:jav ka:kat kg:kon ki:kik kj:kua kk:kaz kl:kal km:khm kn:kan ko:kor "
        "kr:kau ks:kas ku:kur kv:kom kw:cor ky:kir la:lat lb:ltz lg:lug li:lim ln:lin lo:lao lt:lit lu:lub lv:lav mg:mlg mh:mah mi:mri mk:mkd ml:mal mn:mon "
        "mr:mar ms:msa mt:mlt my:mya na:nau nb:nob nd:nde ne:nep ng:ndo nl:nld nn:nno no:nor nr:nbl nv:nav ny:nya oc:oci oj:oji om:orm or:ori os:oss pa:pan "
        "pi:pli pl:pol ps:pus pt:por qu:que rm:roh rn:run ro:ron ru:rus rw:kin sa:san sc:srd sd:snd se:sme sg:sag sh:hbs si:sin sk:slk sl:slv sm:smo sn:sna "
        "so:som sq:sqi sr:srp ss:ssw st:sot su:sun sv:swe sw:swa ta:tam te:tel tg:tgk th:tha ti:tir tk:tuk tl:tgl tn:tsn to:ton tr:tur ts:tso tt:tat tw:twi "
        "ty:tah ug:uig uk:ukr ur:urd uz:uzb ve:ven vi:vie vo:vol wa:wln wo:wol xh:xho yi:yid yo:yor za:zha zh:zho zu:zul"
    ).split()
)


def stop_word_counts(text: Column, words: dict[str, tuple[str, ...]] = STOP_WORDS) -> Column:
    """struct of how many of the text's blank-separated words are stop words of each language."""

    def count(tokens: Column, of: tuple[str, ...]) -> Column:
        return F.size(F.filter(tokens, lambda t: t.isin(*of)))

    return let(F.split(F.lower(text), " "), lambda tokens: F.struct(*[count(tokens, ws).alias(iso) for iso, ws in words.items()]))


def detect(text: Column, words: dict[str, tuple[str, ...]] = STOP_WORDS) -> Column:
    """Predictions by shares of stop words; languages without any are left out."""

    def shares(c: Column) -> Column:
        total = sum((c[iso] for iso in words), F.lit(0))
        entries = [F.struct(F.lit(iso).alias("key"), F.try_divide(c[iso], total).alias("share")) for iso in words]
        found = F.filter(F.array(*entries), lambda e: F.coalesce(e["share"] > 0, F.lit(False)))
        return F.map_from_entries(F.transform(found, lambda e: F.struct(e["key"].alias("key"), F.struct(e["share"].alias("probability"), e["share"].alias("proportion")).alias("value"))))

    return let(stop_word_counts(text, words), shares)


def confident(predictions: Column, probability: float, proportion: float) -> Column:
    """The predictions at or above both thresholds."""
    return F.map_filter(predictions, lambda _, p: (p["probability"] >= probability) & (p["proportion"] >= proportion))


def confident_single(predictions: Column) -> Column:
    """The one language above both strict thresholds, if there is exactly one."""
    sure = F.map_filter(predictions, lambda _, p: (p["probability"] > SINGLE[0]) & (p["proportion"] > SINGLE[1]))
    return F.when(F.size(sure) == 1, F.get(F.map_keys(sure), F.lit(0)))


def predicted_language(iso: Column, predictions: Column) -> Column:
    """The site's language, unless predictions say English alone, or several languages for sure."""

    def predicted(found: Column) -> Column:
        n = F.coalesce(F.size(found), F.lit(0))
        only_english = (iso != "eng") & (n == 1) & F.map_contains_key(found, "eng")
        several = (n != 1) & (F.size(confident(found, *MULTIPLE)) > 1)
        return F.when(n <= 0, iso).when(only_english, "eng").when(several, "mul").otherwise(iso)

    return let(predictions, predicted)


def stored_predictions(predicted: Column, predictions: Column) -> Column:
    """What is kept for display: confident entries, or all where the document is English or mixed."""
    return F.when(predicted.isin("eng", "mul"), predictions).otherwise(confident(predictions, *STORED))


def english_paragraph(iso: Column, predictions: Column) -> Column:
    """Is a paragraph of a site in another language English?"""
    eng = F.try_element_at(predictions, F.lit("eng"))
    sure = (eng["probability"] > ENGLISH_PARAGRAPH[0]) & (eng["proportion"] > ENGLISH_PARAGRAPH[1])
    return (iso != "eng") & eng.isNotNull() & (sure | (F.size(predictions) == 1))


def top_language(predictions: Column) -> Column:
    """The language with the largest probability; of ties the first in the alphabet."""
    entries = F.transform(F.map_entries(predictions), lambda e: F.struct((-e["value"]["probability"]).alias("p"), e["key"].alias("key")))
    return F.array_min(entries)["key"]


def is_supported(iso: Column) -> Column:
    return iso.isin(*DETECTOR_CODES)


def is_unexpected(iso: Column, found: Column) -> Column:
    """Is a detected code neither the site's nor English?  Null for sites that the detector doesn't know."""
    codes = F.create_map(*[F.lit(x) for pair in DETECTOR_CODES.items() for x in pair])
    return F.when(is_supported(iso), (found != F.try_element_at(codes, iso)) & (found != "en"))


def iso3(code: Column) -> Column:
    """A detector's code as ISO 639-3: the script suffix goes, two letters become three; other codes stay."""
    plain = F.regexp_replace(code, "-Latn$", "")
    known = F.create_map(*[F.lit(x) for pair in TWO_LETTERS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, plain), plain)


def top_two(predictions: Column, iso: Column) -> list[Column]:
    """language1, probability1, unexpected1 and the same of the second: the likeliest predictions in two letters, null where there are fewer."""
    entries = F.array_sort(F.transform(F.map_entries(predictions), lambda e: F.struct((-e["value"]["probability"]).alias("p"), e["key"].alias("key"))))
    known = F.create_map(*[F.lit(x) for two, three in TWO_LETTERS.items() for x in (three, two)])
    out = []
    for k in (1, 2):
        found = F.get(entries, F.lit(k - 1))
        code = F.coalesce(F.try_element_at(known, found["key"]), found["key"])
        out += [code.alias(f"language{k}"), (-found["p"]).alias(f"probability{k}"), F.when(found.isNotNull(), is_unexpected(iso, code)).alias(f"unexpected{k}")]
    return out


def language_rows(docs: DataFrame, *, iso: str = "site_language", paragraphs: str = "paragraphs", keep: tuple[str, ...] = ("filename", "url"), detect=detect) -> DataFrame:
    """The two likeliest languages of each document (paragraph -1) and, where it has several paragraphs, of each of them."""
    text_of = F.array_join(paragraphs, " ")
    whole = F.struct(F.lit(-1).alias("paragraph_no"), F.aggregate(paragraphs, F.lit(0).cast("long"), lambda n, p: n + F.length(p)).alias("num_chars"), text_of.alias("text"))
    single = F.transform(paragraphs, lambda p, k: F.struct(k.alias("paragraph_no"), F.length(p).cast("long").alias("num_chars"), p.alias("text")))
    parts = F.concat(F.array(whole), F.when(F.size(paragraphs) > 1, single).otherwise(F.array().cast(docs.select(single.alias("x")).schema["x"].dataType)))
    rows = docs.select(*keep, F.col(iso).alias("_iso"), F.inline(parts)).withColumn("_p", detect(F.col("text")))
    return rows.select(*keep, is_supported(F.col("_iso")).alias("is_supported"), "paragraph_no", "num_chars", *top_two(F.col("_p"), F.col("_iso")))
