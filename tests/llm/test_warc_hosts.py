from jobstrata.llm import warc_index


def test_urls_with_control_characters_in_the_host_are_found(spark):
    urls = ["http://a\tb.com/x", "http://a\nb.com/x", "//\n/first", "http://a b.com/", "http://plain.com/"]
    assert not any(c in warc_index.url_key(u) for u in urls for c in "\t\n ")
    pages = spark.createDataFrame([(k, u, f"<p>{k}</p>") for k, u in enumerate(urls)], "page_id long, url string, html string")
    _, index = warc_index.archive(pages)
    assert sorted(r.page_id for r in warc_index.look_up(warc_index.keys_of(pages), index).collect()) == list(range(len(urls)))
