"""Schemas of the records that go in and out, as DDL."""

PREDICTIONS = "MAP<STRING, STRUCT<cld3_language: STRING, probability: DOUBLE, is_reliable: BOOLEAN, proportion: DOUBLE>>"
DOCUMENT = (
    "filename STRING, url STRING, url_origin STRING, content_type STRING, site_language STRING, time_published STRING, time_modified STRING, time_retrieved STRING, "
    "title STRING, authors ARRAY<STRING>, paragraphs ARRAY<STRING>, n_paragraphs BIGINT, n_chars BIGINT, parallel_article STRING, "
    f"cld3_detected_languages {PREDICTIONS}, predicted_language STRING, sentences ARRAY<ARRAY<STRING>>, tokens ARRAY<ARRAY<ARRAY<STRING>>>, "
    "n_tokens BIGINT, n_sentences BIGINT, keywords ARRAY<STRING>, section STRING"
)
FILEMAP = "Filename STRING, Url STRING, ISO STRING, Language STRING, Sitename STRING, Timestamp STRING, Region STRING"
DOMAIN = "region STRING, iso STRING, language STRING, site_name STRING, news STRING, radio STRING, video STRING, tv STRING, direct STRING"
SITEMAP = "STRUCT<url: STRING, iso: STRING, language: STRING, site_name: STRING, timestamp: STRING, region: STRING>"
PAGE = f"url STRING, sitemap_last_modified STRING, changefreq STRING, priority STRING, archive_url STRING, news MAP<STRING, STRING>, video MAP<STRING, STRING>, sitemap_prov STRUCT<filename: STRING, sitemap: {SITEMAP}>"
#: Fields that a written document lacks where they are empty; other nulls are written.
DROPPED_IF_EMPTY = ("parallel_article", "sentences", "tokens", "n_tokens", "n_sentences")
