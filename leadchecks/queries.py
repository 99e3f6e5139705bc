"""One query per operator, each a function of a session and a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadchecks import fixtures
from placeleads.constants import RESULT_SELECTORS, SELECTORS
from placeleads.functions import contact, html, select, url
from placeleads.functions.text import contains_any
from placeleads.operators import dedup, enrich, extract, failures, merge, report
from placeleads.plans import leads as pipelines
from placeleads.plans import search
from placeleads.schema import DOCUMENT_NAMES, PAGE
from placeleads.sources import files
from placeleads.sources import pages as page_source
from placeleads.sources import results, searched
from placeleads.sources.workdir import new_work_dir
from placeleads.streaming import leads as streaming

# Parameters where a default would leave nothing to compare on the given tables.
LINK_MARK = "/"
DOCUMENT_PHRASES = ("license", "copyright", "@", "password")
KEY_BUCKETS = 8
SEARCH_PARTS = 16
STREAM_SLICES = 3
FILE_SLICES, BAD_SLICES = 7, (2, 5)
STREAM_BATCHES = 10
DOCUMENT_PAGES = 50

LANGUAGE = "^[a-z]+://[^/]+/([a-z]+)/"
DOMAIN_END = r"^[a-z]+://[^/]*\.([a-z]+)/"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_source.read_pages(spark, f"{sf_dir}/pages.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "documents")


def _flat(df: DataFrame) -> DataFrame:
    """Emails as one text, which compares the same in every engine."""
    if "emails" not in df.columns:
        return df
    return df.withColumn("emails", F.array_join("emails", " "))


def _markup(pages: DataFrame) -> DataFrame:
    return pages.withColumn("markup", html.page_markup(F.col("html"))).drop("html")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.place_records(extract.readable_pages(fixtures.place_pages(spark, sf_dir)))


def _second_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.second_run_pages(spark, sf_dir)
    return extract.place_records(extract.readable_pages(pages))


# Scans, sources, sinks


def page_scan(spark, sf_dir):
    pages = page_source.read_pages(spark, f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.md5("html").alias("html_md5"))


def search_result_scan(spark, sf_dir):
    plan = _nation_plan(spark, sf_dir)
    return pipelines.searched_links(fixtures.result_pages(spark, sf_dir), plan)


def searched_page_scan(spark, sf_dir):
    """As ``search_result_scan``, from pages laid out by their search."""
    plan, path = _nation_plan(spark, sf_dir), new_work_dir(spark, "searched-pages")
    searched.write_result_pages(fixtures.result_pages(spark, sf_dir), path, SEARCH_PARTS)
    return pipelines.searched_links(searched.read_searched_pages(spark, path, plan), plan)


def results_sink(spark, sf_dir):
    path = new_work_dir(spark, "results-sink")
    results.write_places(_leads_of_places(spark, sf_dir).select(*_PLACE_COLUMNS), path)
    return _flat(results.read_places(spark, path))


def results_scan(spark, sf_dir):
    """Writes JSON lines under the document names and reads them back."""
    path = new_work_dir(spark, "results-scan")
    results.write_places(_leads_of_places(spark, sf_dir).select(*_PLACE_COLUMNS), path, "json")
    return _flat(results.read_places(spark, path, "json"))


def results_store(spark, sf_dir):
    """Two runs appended to one store, the second one without known places."""
    store = new_work_dir(spark, "results-store")
    for run_id, places in enumerate((_places(spark, sf_dir), _second_places(spark, sf_dir))):
        results.append_run(spark, places, store, run_id, "food & drink", "all", KEY_BUCKETS)
    return _flat(results.read_store(spark, store))


def results_totals(spark, sf_dir):
    """Totals of a store after two runs, and whether the times of both are kept."""
    store = new_work_dir(spark, "results-totals")
    for run_id, places in enumerate((_places(spark, sf_dir), _second_places(spark, sf_dir))):
        results.append_run(spark, places, store, run_id, "food & drink", "all", KEY_BUCKETS)
    updated = F.col("last_updated") > F.col("scraped_at")
    return results.store_totals(spark, store).select(
        "query", "location", "total_found", updated.alias("updated")
    )


def results_documents(spark, sf_dir):
    """Result documents, one for the leads of ``DOCUMENT_PAGES`` pages, read back: the places
    of valid ones, and the numbers of the ones that are cut off."""
    path = new_work_dir(spark, "results-documents")
    leads = _leads_of_places(spark, sf_dir).withColumn("number", _document_number("page_id"))
    named = leads.withColumnsRenamed(DOCUMENT_NAMES)
    place = F.struct(*(DOCUMENT_NAMES.get(c, c) for c in _PLACE_COLUMNS))
    documents = named.groupBy("number").agg(
        F.to_json(
            F.struct(
                F.current_timestamp().alias("scrapedAt"),
                F.lit("food & drink").alias("query"),
                F.lit("all").alias("location"),
                F.count("*").alias("totalFound"),
                F.collect_list(place).alias("results"),
            ),
            {"pretty": "true"},
        ).alias("value")
    )
    cut_off = F.when(F.col("number") % 3 == 1, F.expr("left(value, length(value) - 9)"))
    whole = documents.withColumn("value", F.coalesce(cut_off, "value"))
    whole.repartition("number").write.partitionBy("number").text(path)
    read = results.read_documents(spark, path)
    places = _flat(results.places_of_documents(read)).select("name", "phone", "emails", "place_id")
    number = F.regexp_extract("path", r"number=(\d+)", 1).cast("long")
    bad = results.corrupt_documents(read).select(number.alias("corrupt"))
    return places.unionByName(bad, allowMissingColumns=True)


def document_split(spark, sf_dir):
    """The leads as one indented document, read back by records."""
    path = new_work_dir(spark, "document-split")
    leads = _leads_of_places(spark, sf_dir)
    results.write_document(leads, path, "food & drink", "all", ["page_id"])
    return _flat(results.read_document_places(spark, path).select(*_PLACE_COLUMNS))


def _document_number(page_id: str) -> Column:
    return F.floor(F.col(page_id) / DOCUMENT_PAGES).cast("long")


def results_envelope(spark, sf_dir):
    leads = _leads_of_places(spark, sf_dir)
    return report.results_envelope(leads, "food & drink", "all").drop("scraped_at")


_PLACE_COLUMNS = ("name", "address", "phone", "emails", "has_website", "place_id", "is_active")


def _run_stream(spark: SparkSession, pages: DataFrame, purpose: str, **options) -> str:
    """Lets slices of the pages arrive in the order of ``page_id``; each time the stream
    starts again from its checkpoint and takes what is new as one batch."""
    folder, store = new_work_dir(spark, f"{purpose}-files"), new_work_dir(spark, purpose)
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    step = (high - low) // STREAM_SLICES + 1
    for start in range(low, high + 1, step):
        arrived = pages.where(F.col("page_id").between(start, start + step - 1))
        arrived.select("page_id", "url", "html").write.mode("append").parquet(folder)
        stream = page_source.stream_pages(spark, folder)
        query = streaming.start_lead_stream(stream, store, f"{store}/checkpoint", **options)
        streaming.await_lead_stream(query)
    return store


def stream_leads(spark, sf_dir):
    store = _run_stream(spark, fixtures.place_pages(spark, sf_dir), "stream-leads")
    return _flat(streaming.read_stream_leads(spark, store).select("page_id", *_PLACE_COLUMNS))


def stream_dedup(spark, sf_dir):
    store = _run_stream(spark, _pages(spark, sf_dir), "stream-dedup")
    return streaming.read_sightings(spark, store).select("page_id", "name_key")


def stream_resume(spark, sf_dir):
    """Half of the pages with one checkpoint, then all pages with another one on the same
    store, which must add what is new and lose nothing."""
    pages = fixtures.place_pages(spark, sf_dir).select("page_id", "url", "html")
    store = new_work_dir(spark, "stream-resume")
    middle = F.lit(pages.agg(F.avg("page_id")).first()[0])
    for turn, arrived in enumerate((pages.where(F.col("page_id") < middle), pages)):
        folder = new_work_dir(spark, "stream-resume-files")
        arrived.write.parquet(folder)
        stream = page_source.stream_pages(spark, folder)
        query = streaming.start_lead_stream(stream, store, f"{store}/checkpoint-{turn}")
        streaming.await_lead_stream(query)
    return _flat(streaming.read_stream_leads(spark, store).select("page_id", *_PLACE_COLUMNS))


def stream_hooks(spark, sf_dir):
    """What the hooks of a stream are given, in total."""
    received, counts = new_work_dir(spark, "stream-hooks-received"), []

    def keep(found: DataFrame, batch_id: int) -> None:
        found.select("page_id").write.mode("overwrite").parquet(f"{received}/batch={batch_id}")

    pages = fixtures.place_pages(spark, sf_dir)
    _run_stream(spark, pages, "stream-hooks", on_result=keep, on_progress=counts.append)
    progress = spark.createDataFrame(counts, "processed long, quarantined long, found long")
    given = spark.read.schema("page_id long").parquet(received).agg(F.count("*").alias("received"))
    both = progress.unionByName(given, allowMissingColumns=True)
    return both.agg(*(F.sum(c).alias(c) for c in both.columns))


def _run_batches(spark: SparkSession, pages: DataFrame, purpose: str, **options) -> tuple:
    """All slices in one run of the stream, ``STREAM_BATCHES`` batches of a file each."""
    folder, store = new_work_dir(spark, f"{purpose}-files"), new_work_dir(spark, purpose)
    low, high = pages.agg(F.min("page_id"), F.max("page_id")).first()
    step = (high - low) // STREAM_BATCHES + 1
    for start in range(low, high + 1, step):
        arrived = pages.where(F.col("page_id").between(start, start + step - 1))
        arrived.select("page_id", "url", "html").coalesce(1).write.mode("append").parquet(folder)
    stream = page_source.stream_pages(spark, folder, max_files=1)
    query = streaming.start_lead_stream(stream, store, f"{store}/checkpoint", **options)
    streaming.await_lead_stream(query)
    return store, query


def stream_batches(spark, sf_dir):
    """Ten batches of one run, then the small commits of the store made one."""
    store, _ = _run_batches(spark, fixtures.place_pages(spark, sf_dir), "stream-batches")
    streaming.stream_store(spark, store).compact()
    found = streaming.read_stream_leads(spark, store)
    return _flat(found.select("page_id", "batch_id", *_PLACE_COLUMNS))


def stream_progress(spark, sf_dir):
    """What is observed in each of ten batches, as the listener hands it on."""
    counts = []
    pages = fixtures.place_pages(spark, sf_dir)
    _run_batches(spark, pages, "stream-progress", on_progress=counts.append)
    schema = "batch_id long, processed long, quarantined long, found long"
    return spark.createDataFrame(counts, schema)


def stream_totals(spark, sf_dir):
    """The totals of a store, and whether they tell when the last lead came."""
    store = _run_stream(spark, fixtures.place_pages(spark, sf_dir), "stream-totals")
    totals = streaming.stream_totals(spark, store)
    return totals.select("total_found", F.col("last_updated").isNotNull().alias("updated"))


def stream_quarantine(spark, sf_dir):
    store = _run_stream(spark, fixtures.place_pages(spark, sf_dir), "stream-quarantine")
    return streaming.read_quarantine(spark, store).select("page_id", "url", "reason")


def stream_branches(spark, sf_dir):
    """Places that agree in name and address only count as one."""
    pages = fixtures.place_pages(spark, sf_dir)
    store = _run_stream(spark, pages, "stream-branches", keys=("name", "address"))
    return _flat(streaming.read_stream_leads(spark, store).select("page_id", *_PLACE_COLUMNS))


def stream_append(spark, sf_dir):
    emails = enrich.lookup_emails(fixtures.lookup_pages(spark, sf_dir))
    pages = fixtures.place_pages(spark, sf_dir)
    store = _run_stream(spark, pages, "stream-append", emails=emails)
    return report.contact_summary(streaming.read_stream_leads(spark, store))


def unreadable_files(spark, sf_dir):
    """Pages in ``FILE_SLICES`` folders, two of which hold something else than Parquet: the pages that
    are read all the same, and the folders of the files that are not, with the reason."""
    path = new_work_dir(spark, "unreadable-files")
    pages = _pages(spark, sf_dir).withColumn("slice", F.col("page_id") % FILE_SLICES)
    pages = pages.where(F.col("slice") >= 0)
    is_bad = F.col("slice").isin(*BAD_SLICES)
    # Each task that scans pages writes its own file to a folder.
    pages.where(~is_bad).write.partitionBy("slice").parquet(path)
    bad_pages = pages.where(is_bad).select("slice", "html")
    bad_pages.write.mode("append").partitionBy("slice").text(path)
    read = page_source.read_pages(spark, path, intact=True).select("page_id")
    bad = files.unreadable_files(spark, path, PAGE)
    number = F.regexp_extract("path", r"slice=(\d+)", 1).cast("long").alias("slice")
    bad_folders = bad.select(number, "reason").distinct()
    return read.unionByName(bad_folders, allowMissingColumns=True)


def failed_searches(spark, sf_dir):
    """Searches without a captured result page, or with none that has HTML."""
    pages = fixtures.result_pages(spark, sf_dir).where("page_id % 4 <> 0")
    partly = pages.withColumn("html", F.when(F.col("page_id") % 3 != 0, F.col("html")))
    return failures.failed_searches(_nation_plan(spark, sf_dir), partly)


def failed_lookups(spark, sf_dir):
    pages = fixtures.lookup_pages(spark, sf_dir).where("lookup_id % 3 <> 0")
    partly = pages.withColumn("html", F.when(F.col("lookup_id") % 5 != 0, F.col("html")))
    found = pipelines.find_leads(fixtures.place_pages(spark, sf_dir))
    return failures.failed_lookups(found, partly)


# Search plans


def category_dim(spark, sf_dir):
    return search.category_dimension(fixtures.table(spark, sf_dir, "supplier").select("s_suppkey"))


def location_parse(spark, sf_dir):
    location = F.col("location")
    return fixtures.locations(spark, sf_dir).select(
        "s_suppkey",
        search.location_area(location).alias("area"),
        search.location_country(location).alias("country"),
    )


def subdivide_location(spark, sf_dir):
    variants = search.sub_locations(F.col("location"))
    return fixtures.locations(spark, sf_dir).select(
        "s_suppkey", F.posexplode(variants).alias("seq", "place")
    )


def zone_searches(spark, sf_dir):
    variants = search.zone_locations(F.col("location"))
    return fixtures.locations(spark, sf_dir).select(
        "s_suppkey", F.posexplode(variants).alias("seq", "place")
    )


def search_plan(spark, sf_dir):
    return search.search_plan(fixtures.locations(spark, sf_dir))


def search_plan_zones(spark, sf_dir):
    return search.search_plan(fixtures.locations(spark, sf_dir), include_zones=True)


def plan_preview(spark, sf_dir):
    return search.plan_preview(fixtures.locations(spark, sf_dir))


def search_text(spark, sf_dir):
    part, nation = fixtures.table(spark, sf_dir, "part"), fixtures.table(spark, sf_dir, "nation")
    blank = F.when(F.col("p_partkey") % 3 == 0, "  ").otherwise(F.col("p_type"))
    joined = part.join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey"))
    return joined.select("p_partkey", search.search_text(blank, F.col("n_name")).alias("search_query"))


def _nation_plan(spark, sf_dir):
    nation = fixtures.table(spark, sf_dir, "nation").select(F.col("n_name").alias("location"))
    return search.search_plan(nation)


# Extraction


def text_content(spark, sf_dir):
    return _markup(_pages(spark, sf_dir)).select(
        "page_id", html.text_content(F.col("markup")).alias("text")
    )


def element_pick(spark, sf_dir):
    markup = F.col("markup")
    return _markup(fixtures.place_pages(spark, sf_dir)).select(
        "page_id",
        html.element_text(markup, SELECTORS["phone"]).alias("phone_element"),
        html.element_text(markup, SELECTORS["address"]).alias("address_element"),
        html.element_text(markup, SELECTORS["panel"]).alias("panel"),
    )


def selector_pick(spark, sf_dir):
    """Result lists by selectors with steps: the first container present, items that are
    grandchildren of a feed, links, and elements whose end tags are left out."""
    markup = F.col("markup")

    def texts(selector: str) -> Column:
        return F.array_join(F.transform(select.elements(markup, selector), lambda e: e["text"]), "|")

    link = select.first_element(markup, RESULT_SELECTORS["link"])["tag"]
    return _markup(fixtures.feed_pages(spark, sf_dir)).select(
        "page_id",
        html.element_text(markup, RESULT_SELECTORS["container"]).alias("container"),
        texts(RESULT_SELECTORS["item"][0]).alias("items"),
        select.attribute(link, "href").alias("link"),
        texts("div[jsaction] > p").alias("paragraphs"),
        texts("ul > li").alias("points"),
        html.has_element(markup, ("#pane > span > div",)).alias("in_pane"),
    )


def place_name(spark, sf_dir):
    name = html.trimmed_element_text(F.col("markup"), SELECTORS["name"])
    return _markup(_pages(spark, sf_dir)).select("page_id", name.alias("name"))


def place_id(spark, sf_dir):
    return fixtures.place_pages(spark, sf_dir).select(
        "page_id", url.place_id(F.col("url")).alias("place_id")
    )


def is_active(spark, sf_dir):
    return _places(spark, sf_dir).select("page_id", "is_active")


def is_active_documents(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", F.lower("text").alias("text"))
    return docs.select("doc_id", (~contains_any(F.col("text"), DOCUMENT_PHRASES)).alias("is_active"))


def extract_phone(spark, sf_dir):
    return _documents(spark, sf_dir).select(
        "doc_id", contact.extract_phone(F.col("text")).alias("phone")
    )


def extract_phone_pages(spark, sf_dir):
    text = _markup(_pages(spark, sf_dir)).select(
        "page_id", html.text_content(F.col("markup")).alias("text")
    )
    return text.select("page_id", contact.extract_phone(F.col("text")).alias("phone"))


def place_phone(spark, sf_dir):
    return _places(spark, sf_dir).select("page_id", "phone")


def place_address(spark, sf_dir):
    return _places(spark, sf_dir).select("page_id", "address")


def has_website(spark, sf_dir):
    return _places(spark, sf_dir).select("page_id", "has_website")


def extract_emails(spark, sf_dir):
    found = contact.extract_emails(F.col("text"), blocked=("mail1.",))
    return _documents(spark, sf_dir).select("doc_id", F.explode(found).alias("email"))


def extract_emails_default(spark, sf_dir):
    """The default block list on documents, as a count of what is left per document."""
    found = contact.extract_emails(F.col("text"))
    return _documents(spark, sf_dir).select("doc_id", F.size(found).alias("emails_left"))


def page_links(spark, sf_dir):
    return extract.links(_pages(spark, sf_dir), LINK_MARK)


def absolute_url(spark, sf_dir):
    found = extract.links(_pages(spark, sf_dir), LINK_MARK)
    return found.select("page_id", "link_pos", url.absolute_url(F.col("href")).alias("url"))


def place_record(spark, sf_dir):
    return _flat(_places(spark, sf_dir))


def address_city(spark, sf_dir):
    return _places(spark, sf_dir).select(
        "page_id", contact.address_city(F.col("address")).alias("city")
    )


def lookup_query(spark, sf_dir):
    query = contact.lookup_query(F.col("name"), F.col("address"))
    return _places(spark, sf_dir).select("page_id", query.alias("lookup_query"))


def url_component(spark, sf_dir):
    names = place_name(spark, sf_dir)
    return names.select("page_id", url.url_component(F.col("name")).alias("component"))


def lookup_text(spark, sf_dir):
    texts = enrich.lookup_texts(fixtures.lookup_pages(spark, sf_dir))
    return texts.select("lookup_id", F.col("_text").alias("text"))


def lookup_candidates(spark, sf_dir):
    found = contact.lookup_candidates(F.col("text"))
    return lookup_text(spark, sf_dir).select(
        "lookup_id", F.posexplode(found).alias("pos", "email")
    )


def preferred_email(spark, sf_dir):
    found = contact.preferred_email(contact.lookup_candidates(F.col("text")))
    return lookup_text(spark, sf_dir).select("lookup_id", found.alias("email"))


# Filters, dedup, joins


def lead_filter(spark, sf_dir):
    return _flat(dedup.leads_only(_places(spark, sf_dir)))


def dedup_name(spark, sf_dir):
    return dedup.dedup_by_name(place_name(spark, sf_dir), ["page_id"])


def dedup_key(spark, sf_dir):
    places = dedup.dedup_by_place(_places(spark, sf_dir), ["page_id"])
    return places.select("page_id", "place_key", "name")


def email_enrich(spark, sf_dir):
    leads = _leads_of_places(spark, sf_dir)
    emails = enrich.lookup_emails(fixtures.lookup_pages(spark, sf_dir))
    return _flat(enrich.enrich_emails(leads, emails)).select("page_id", "name", "emails")


def merge_anti_id(spark, sf_dir):
    kept = merge.new_by_id(_second_places(spark, sf_dir), _places(spark, sf_dir))
    return kept.select("page_id", "place_id", "name")


def merge_anti_name(spark, sf_dir):
    kept = merge.new_by_name(_second_places(spark, sf_dir), _places(spark, sf_dir))
    return kept.select("page_id", "place_id", "name")


def merge_results(spark, sf_dir):
    existing = _places(spark, sf_dir).withColumn("side", F.lit("existing"))
    new = _second_places(spark, sf_dir).withColumn("side", F.lit("new"))
    return _flat(merge.merge_results(existing, new))


def quarantine(spark, sf_dir):
    return extract.quarantine(fixtures.place_pages(spark, sf_dir)).select("page_id", "url", "reason")


# Reports


def _leads_of_places(spark, sf_dir):
    return pipelines.find_leads(fixtures.place_pages(spark, sf_dir))


def contact_summary(spark, sf_dir):
    return report.contact_summary(_leads_of_places(spark, sf_dir))


def links_per_query(spark, sf_dir):
    """Distinct links per page and per language of the site."""
    pages = _pages(spark, sf_dir).withColumn("lang", F.regexp_extract("url", LANGUAGE, 1))
    return report.links_per_query(extract.links(pages, LINK_MARK), ["lang"])


def running_unique(spark, sf_dir):
    places = _places(spark, sf_dir).withColumn(
        "place_key", dedup.place_key(F.col("place_id"), F.col("name"))
    )
    return report.running_unique(places, "place_key", "query_seq", ["location"])


def running_unique_pages(spark, sf_dir):
    pages = _pages(spark, sf_dir).select(
        F.regexp_extract("url", DOMAIN_END, 1).alias("site"),
        F.regexp_extract("url", LANGUAGE, 1).alias("lang"),
        html.page_markup(F.col("html")).alias("markup"),
    )
    name = html.trimmed_element_text(F.col("markup"), SELECTORS["name"])
    named = pages.select("site", "lang", F.lower(name).alias("name_key"))
    return report.running_unique(named, "name_key", "lang", ["site"])


def progress_counts(spark, sf_dir):
    pages = fixtures.place_pages(spark, sf_dir)
    return report.progress_counts(pages, pipelines.find_leads(pages), ["query_seq"])


def progress_observed(spark, sf_dir):
    """Pages and leads counted while the leads are written, in the same pass."""
    pages, read = report.observe_progress(fixtures.place_pages(spark, sf_dir), "pages")
    found, kept = report.observe_progress(pipelines.find_leads(pages), "leads")
    results.write_places(found.select(*_PLACE_COLUMNS), new_work_dir(spark, "progress"))
    counts = [(read.get["rows"], kept.get["rows"])]
    return spark.createDataFrame(counts, "processed long, found long")


# Pipelines


def leads(spark, sf_dir):
    found = pipelines.find_leads(
        fixtures.place_pages(spark, sf_dir), fixtures.lookup_pages(spark, sf_dir)
    )
    return _flat(found)


def subdivided_leads(spark, sf_dir):
    found = pipelines.find_leads_by_plan(
        _nation_plan(spark, sf_dir),
        fixtures.result_pages(spark, sf_dir),
        fixtures.place_pages(spark, sf_dir).select("page_id", "url", "html"),
        fixtures.lookup_pages(spark, sf_dir),
    )
    return _flat(found)


ALL = {
    f.__name__: f
    for f in (
        page_scan,
        search_result_scan,
        searched_page_scan,
        results_sink,
        results_scan,
        results_store,
        results_totals,
        results_documents,
        document_split,
        results_envelope,
        unreadable_files,
        failed_searches,
        failed_lookups,
        stream_leads,
        stream_dedup,
        stream_resume,
        stream_hooks,
        stream_batches,
        stream_progress,
        stream_totals,
        stream_quarantine,
        stream_branches,
        stream_append,
        category_dim,
        location_parse,
        subdivide_location,
        zone_searches,
        search_plan,
        search_plan_zones,
        plan_preview,
        search_text,
        text_content,
        element_pick,
        selector_pick,
        place_name,
        place_id,
        is_active,
        is_active_documents,
        extract_phone,
        extract_phone_pages,
        place_phone,
        place_address,
        has_website,
        extract_emails,
        extract_emails_default,
        page_links,
        absolute_url,
        place_record,
        address_city,
        lookup_query,
        url_component,
        lookup_text,
        lookup_candidates,
        preferred_email,
        lead_filter,
        dedup_name,
        dedup_key,
        email_enrich,
        merge_anti_id,
        merge_anti_name,
        merge_results,
        quarantine,
        contact_summary,
        links_per_query,
        running_unique,
        running_unique_pages,
        progress_counts,
        progress_observed,
        leads,
        subdivided_leads,
    )
}
