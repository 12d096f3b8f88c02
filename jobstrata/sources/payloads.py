"""Landed API responses -> postings in one raw layout.

A response is one JSON object, ``{"page_no": 3, "data": [posting, ...]}``, on a line of its own or in a file of its own;
``page_no`` is the request number and keeps the order in which postings were seen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobstrata import schemas
from jobstrata.functions import dates, links, text


def response_schema(platform: str) -> T.StructType:
    return T.StructType([T.StructField("page_no", T.LongType()), *schemas.PAYLOADS[platform].fields])


def read_bodies(spark: SparkSession, path: str | Sequence[str], platform: str, layout: str = "lines") -> DataFrame:
    """``file, page_no, data, broken`` of every landed body; ``broken`` holds the text of one that cannot be read.

    ``layout`` says how bodies lie in the files: ``lines``, one JSON object per line, or ``bodies``, one object per file
    in any formatting, as a response is saved. A body that says no ``page_no`` gets 0.
    """
    if layout not in ("lines", "bodies"):
        raise ValueError(f"unknown layout {layout}")
    schema = response_schema(platform).add("_broken", "string")
    read = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_broken").option("multiLine", layout == "bodies")
    # Spark refuses to read the column of broken records alone, so it is taken next to another
    broken = F.when(F.col("_broken").isNotNull() | F.col("data").isNotNull(), F.col("_broken"))
    return read.json(path).select(F.col("_metadata.file_path").alias("file"), F.coalesce("page_no", F.lit(0)).alias(
        "page_no"), "data", broken.alias("broken"))


def write_bodies(bodies: DataFrame, folder: str, *, number: str = "page_no", body: str = "body", per_folder: int = 1000) -> int:
    """Save every body in a file of its own named by its number, which must be unique, ``per_folder`` to a folder below
    ``folder``; how many. ``folder/*`` is the path to read.

    Tasks write the files where they lie: Spark's writer would give each a checksum file, start two processes for their
    permissions and leave all moves to the driver. A repeated task writes the same files again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
        place, inner = fs.FileSystem.from_uri(at)
        made = set()
        for batch in batches:
            for n, text in zip(*(c.to_pylist() for c in batch.columns)):
                below = f"{inner.rstrip('/')}/pages-{'none' if n is None else n // per_folder}"
                if below not in made:
                    place.create_dir(below, recursive=True)
                    made.add(below)
                with place.open_output_stream(f"{below}/{'none' if n is None else n}.json", compression=None) as file:
                    file.write(text.encode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return bodies.select(number, body).mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def broken_bodies(bodies: DataFrame) -> DataFrame:
    """Number of unreadable bodies per file."""
    return bodies.filter(F.col("broken").isNotNull()).groupBy("file").agg(F.count(F.lit(1)).alias("n_broken"))


def read_responses(spark: SparkSession, path: str | Sequence[str], platform: str, layout: str = "lines",
                   on_broken: str = "raise") -> DataFrame:
    """One row per posting of the landed files: ``source`` (the file), ``page_no``, ``pos`` and the struct ``job``.

    Responses without ``data`` give no rows. Unreadable bodies raise, or on demand (``on_broken="skip"``) are left out;
    :func:`broken_bodies` counts them.
    """
    bodies = read_bodies(spark, path, platform, layout)
    broken = F.col("broken").isNotNull()
    if on_broken == "raise":  # part of the value, so that no filter can run before it
        fail = F.raise_error(F.concat(F.lit("unreadable response in "), F.col("file")))
        return _postings(bodies.select(F.col("file").alias("source"), "page_no", F.when(broken, fail).otherwise(F.col("data")).alias("data")))
    return _postings(bodies.filter(~broken).select(F.col("file").alias("source"), "page_no", "data"))


def parse_responses(bodies: DataFrame, platform: str, body: str = "body", on_broken: str = "raise") -> DataFrame:
    """Same for responses landed in a table with ``page_no``, a JSON text column and perhaps ``source``; a NULL body has no
    postings."""
    mode = "FAILFAST" if on_broken == "raise" else "PERMISSIVE"
    parsed = F.from_json(body, schemas.PAYLOADS[platform], {"mode": mode})
    source = F.col("source") if "source" in bodies.columns else F.lit(None).cast("string")
    return _postings(bodies.select(source.alias("source"), "page_no", parsed["data"].alias("data")))


def _postings(df: DataFrame) -> DataFrame:
    return df.select("source", F.coalesce("page_no", F.lit(0)).alias("page_no"), F.posexplode("data").alias("pos", "job"))


def _raw(df: DataFrame, platform: str, **fields: Column) -> DataFrame:
    kinds = {f.name: f.dataType for f in schemas.POSTING_RAW}
    given = {"platform": F.lit(platform), "source": F.col("source"), "page_no": F.col("page_no"), "pos": F.col("pos"), **fields}
    return df.select(*[given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()])


def _one_place(name: Column) -> Column:
    return F.when(name.isNotNull(), F.array(name))


def flatten_careerviet(df: DataFrame) -> DataFrame:
    j = F.col("job")
    return _raw(df, "careerviet", job_id=j.job_id, job_title=j.job_title, created_on=j.date_view,
                emp_name=j.emp_name, location_raw=text.parse_literal_list(j.location_name), job_link=j.job_link)


def flatten_vietnamworks(df: DataFrame) -> DataFrame:
    j = F.col("job")
    return _raw(df, "vietnamworks", job_id=j.jobId, job_title=j.jobTitle, created_on=j.createdOn,
                emp_name=j.companyName, job_link=j.jobUrl, skills=skill_names(j.skills),
                location_raw=_one_place(last_city(j.workingLocations)))


def flatten_monster(df: DataFrame) -> DataFrame:
    j = F.col("job")
    return _raw(df, "monster", job_id=j.jobId, job_title=j.title, created_on=j.createdAt, emp_name=j.company["name"],
                job_link=j.applyUrl, location_raw=_one_place(first_city(j.locations)), skills=skill_texts(j.itSkills))


def flatten_topdev(df: DataFrame) -> DataFrame:
    j = F.col("job")
    return _raw(df, "topdev", job_id=F.md5(j.detail_url), job_title=j.title, created_on=j.published.date,
                emp_name=j.company.display_name, job_link=j.detail_url, skills=j.skills_arr,
                location_raw=_one_place(j.company.addresses.address_short_region_list))


def flatten_itviec(df: DataFrame, run_ts: Column) -> DataFrame:
    j = F.col("job")
    return _raw(df, "itviec", job_id=links.url_id(j.url), job_title=text.strip(j.title),
                created_on=dates.age_to_date(j.age_text, run_ts).cast("string"),
                emp_name=text.strip(j.company), job_link=j.url, location_raw=_one_place(text.strip(j.location)),
                skills=text.merge_tags(j.tags, j.tooltip))


def json_field(body: Column, name: str, kind: str) -> Column:
    """One field of a JSON text; NULL where the text or the field cannot be read."""
    return F.from_json(body, f"`{name}` {kind}")[name]


def skill_names(skills: Column) -> Column:
    """Names of nested skill objects; NULL when the posting lists none."""
    return F.when(F.size(skills) > 0, F.transform(skills, lambda s: s.skillName))


def skill_texts(skills: Column) -> Column:
    """Texts of nested skill objects; an empty array when the posting lists none."""
    return F.coalesce(F.transform(skills, lambda s: s.text), F.array().cast("array<string>"))


def last_city(places: Column) -> Column:
    return F.try_element_at(places, F.lit(-1)).cityNameVI


def first_city(places: Column) -> Column:
    return F.get(places, F.lit(0)).city


def flatten(df: DataFrame, platform: str, run_ts: Column) -> DataFrame:
    """Postings of one API site in the raw layout."""
    if platform == "itviec":
        return flatten_itviec(df, run_ts)
    by_site = {"careerviet": flatten_careerviet, "vietnamworks": flatten_vietnamworks,
               "monster": flatten_monster, "topdev": flatten_topdev}
    return by_site[platform](df)


def read_platform(spark: SparkSession, path: str | Sequence[str], platform: str, run_ts: Column, layout: str = "lines",
                  on_broken: str = "raise") -> DataFrame:
    """Landed files of one API site in the raw layout."""
    return flatten(read_responses(spark, path, platform, layout, on_broken), platform, run_ts)
