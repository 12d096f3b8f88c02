"""Canonical table layouts."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


STR, INT, LONG, DATE, BOOL, DBL = (T.StringType(), T.IntegerType(), T.LongType(), T.DateType(),
                                   T.BooleanType(), T.DoubleType())
STRINGS = T.ArrayType(STR)

# ``source`` names the request or file a posting was read from; with page and position it gives the order of arrival
POSTING_RAW = _struct(
    platform=STR, source=STR, page_no=LONG, pos=INT, job_id=STR, job_title=STR, created_on=STR, emp_name=STR,
    location_raw=STRINGS, job_link=STR, skills=STRINGS, job_desc=STR,
)

POSTING_COLUMNS = ["job_id", "job_title", "created_on", "emp_name", "location_name", "label", "job_link"]

MASTER = _struct(job_id=STR, job_title=STR, date_view=STR, emp_raw=STR, location_name=STR,
                 label_name=STR, job_link=STR)
JOB_SKILL = _struct(job_id=STR, skill_raw=STR)

DIMENSIONS = {
    "location_dim": ("location_id", "location_name", _struct(location_id=LONG, location_name=STR)),
    "date_dim": ("date_id", "actual_date", _struct(date_id=LONG, actual_date=DATE)),
    "label_dim": ("label_id", "label_name", _struct(label_id=LONG, label_name=STR)),
    "emp_dim": ("emp_id", "emp_raw", _struct(emp_id=LONG, emp_raw=STR, emp_cleaned=STR)),
    "skill_dim": ("skill_id", "skill_raw", _struct(skill_id=LONG, skill_raw=STR, skill_cleaned=STR)),
}

FACT_POSTINGS = _struct(
    job_id=STR, job_title=STR, is_expired=BOOL, job_link=STR, last_seen_id=LONG, location_id=LONG,
    label_id=LONG, emp_id=LONG, created_on_id=LONG,
)
FACT_SKILL = _struct(skill_id=LONG, job_id=STR)

TABLES = {**{name: spec[2] for name, spec in DIMENSIONS.items()},
          "fact_job_postings": FACT_POSTINGS, "fact_skill": FACT_SKILL}

# tables kept in a fixed number of parts by a hash of a column: only the parts a batch meets are rewritten
PARTED = {"fact_job_postings": ("job_id", 64)}

LISTING_PAGE = _struct(platform=STR, source=STR, page_no=LONG, html=STR)
DETAIL_FETCH = _struct(platform=STR, job_id=STR, status=INT, fetched_at=STR, html=STR)

GAZETTEER = _struct(city=STR, admin1=STR, lat=DBL, lon=DBL)

# ---- API payloads: one JSON object per response, the postings under "data" --------------------


def _response(job: T.StructType) -> T.StructType:
    return _struct(data=T.ArrayType(job))


PAYLOADS = {
    "careerviet": _response(_struct(job_id=STR, job_title=STR, date_view=STR, emp_name=STR,
                                    location_name=STR, job_link=STR)),
    "vietnamworks": _response(_struct(
        jobId=STR, jobTitle=STR, createdOn=STR, companyName=STR, jobUrl=STR,
        skills=T.ArrayType(_struct(skillName=STR)),
        workingLocations=T.ArrayType(_struct(cityNameVI=STR)))),
    "monster": _response(_struct(
        jobId=STR, title=STR, createdAt=STR, applyUrl=STR, itSkills=T.ArrayType(_struct(text=STR)),
        locations=T.ArrayType(_struct(city=STR)), company=_struct(name=STR))),
    "topdev": _response(_struct(
        title=STR, detail_url=STR, published=_struct(date=STR),
        company=_struct(display_name=STR, addresses=_struct(address_short_region_list=STR)),
        skills_arr=STRINGS)),
    "itviec": _response(_struct(
        title=STR, url=STR, company=STR, location=STR, age_text=STR, tags=STRINGS, tooltip=STR)),
}
