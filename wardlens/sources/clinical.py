"""The seven clinical base tables.

``from_tables`` takes a real clinical schema (catalog tables or views of any
format).  ``from_driver_tables`` shapes the generic order/line-item tables of the
test data into the same seven tables; ``VIEW_SQL`` is written so that one text
runs on Spark and on DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ClinicalTables:
    patients: DataFrame
    admissions: DataFrame
    icustays: DataFrame
    chartevents: DataFrame
    labevents: DataFrame
    prescriptions: DataFrame
    diagnoses_icd: DataFrame


TABLE_NAMES = [
    "patients",
    "admissions",
    "icustays",
    "chartevents",
    "labevents",
    "prescriptions",
    "diagnoses_icd",
]

# {TS}/{STR} are the timestamp and string type names, {orders} etc. the inputs.
VIEW_SQL = {
    "patients": """
select c_custkey subject_id,
       case when c_custkey % 25 = 0 then 'U' when c_custkey % 2 = 0 then 'M' else 'F' end gender,
       {TS} '1990-01-01 00:00:00' - cast((c_custkey*7919) % 36500 as int) * interval '1' day dob
from {customer}""",
    "admissions": """
select o_orderkey hadm_id, o_custkey subject_id, o_orderdate admittime,
       o_orderdate + cast(2 + o_orderkey % 15 as int) * interval '1' day dischtime,
       case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT'
            then o_orderdate + cast(2 + o_orderkey % 15 as int) * interval '1' day end deathtime,
       case when o_orderstatus = 'F' and o_orderpriority = '1-URGENT' then 1 else 0 end hospital_expire_flag,
       case when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then 0 else 1 end has_chartevents_data,
       case when o_orderkey % 23 = 0 then 'HOSPICE-HOME' when o_orderkey % 29 = 0 then 'DEAD/EXPIRED' else 'HOME' end discharge_location,
       o_orderpriority admission_type, o_orderstatus diagnosis,
       case o_orderkey % 3 when 0 then 'Medicare' when 1 then 'Private' else 'Medicaid' end insurance,
       case o_orderkey % 2 when 0 then 'A' else 'B' end ethnicity
from {orders}""",
    "icustays": """
select hadm_id*10+k icustay_id, hadm_id, intime, los,
       intime + cast(floor(coalesce(los, 0e0)*24) as int) * interval '1' hour outtime
from (select hadm_id, k, admittime + cast(k as int) * interval '1' day intime,
             case when hadm_id % 97 = 0 then null
                  else cast((hadm_id*13+k*7) % 200 as double)/10e0 - 0.5e0 end los
      from (select o_orderkey hadm_id, o_orderdate admittime, 1 k from {orders}
            union all
            select o_orderkey hadm_id, o_orderdate admittime, 2 k from {orders} where o_orderkey % 8 = 0) s) t""",
    "chartevents": """
select l_orderkey*10 + case when l_orderkey % 8 = 0 and l_suppkey % 2 = 0 then 2 else 1 end icustay_id,
       case l_suppkey % 6 when 0 then 211 when 1 then 220045 when 2 then 220179 when 3 then 646 when 4 then 678 else 618 end itemid,
       case when l_partkey % 40 = 0 then null when l_partkey % 53 = 0 then 350e0 else 40e0 + l_quantity*2.2e0 end valuenum,
       case when l_partkey % 31 = 0 then 1 when l_partkey % 3 = 0 then 0 else null end error
from {lineitem}""",
    "labevents": """
select l_orderkey hadm_id, itemid,
       case when l_partkey % 37 = 0 then null else case itemid
         when 50912 then l_quantity/10e0 when 51301 then 2e0+l_quantity/3e0 when 51300 then 2e0+l_quantity/3e0
         when 50813 then l_quantity/9e0 when 51222 then 5e0+l_quantity/4e0 when 51265 then 40e0+l_quantity*8e0
         when 50983 then 125e0+l_quantity*0.6e0 when 50971 then 2.5e0+l_quantity*0.08e0
         when 50931 then 60e0+l_quantity*5e0 else l_quantity*2e0 end end valuenum
from (select l_orderkey, l_partkey, l_quantity,
             case l_partkey % 10 when 0 then 50912 when 1 then 51301 when 2 then 51300 when 3 then 50813 when 4 then 51222
               when 5 then 51265 when 6 then 50983 when 7 then 50971 when 8 then 50931 else 51006 end itemid from {lineitem}) s""",
    "prescriptions": """
select l_orderkey hadm_id,
       case when l_partkey % 71 = 0 then null when p_name like '%bolt%' then concat('Heparin ', p_name)
            when p_name like '%gear%' then concat('INSULIN ', p_name) else p_name end drug,
       p_brand formulary_drug_cd, p_type drug_type,
       case when l_suppkey % 33 = 0 then null else l_shipdate end startdate
from {lineitem} join {part} on l_partkey = p_partkey""",
    "diagnoses_icd": """
select l_orderkey hadm_id,
       case when l_returnflag = 'R' and l_suppkey % 20 = 0 then '99592'
            when l_returnflag = 'A' and l_suppkey % 25 = 0 then '5849'
            else concat('V', cast(l_linenumber as {STR})) end icd9_code
from {lineitem}""",
}

_INPUTS = ["customer", "orders", "lineitem", "part"]


def duckdb_view(name: str) -> str:
    """The text of one view for DuckDB, over its registered tables."""
    text = VIEW_SQL[name].replace("{TS}", "timestamp").replace("{STR}", "varchar")
    for table in _INPUTS:
        text = text.replace("{" + table + "}", table)
    return text.strip()


def from_driver_tables(spark: SparkSession, sf_dir: str) -> ClinicalTables:
    """Clinical views over ``<sf_dir>/{customer,orders,lineitem,part}.parquet``."""
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _INPUTS}
    views = {}
    for name, text in VIEW_SQL.items():
        text = text.replace("{TS}", "timestamp_ntz").replace("{STR}", "string")
        used = {t: f for t, f in frames.items() if "{" + t + "}" in text}
        views[name] = spark.sql(text, **used)
    return ClinicalTables(**views)


def from_tables(spark: SparkSession, schema: str) -> ClinicalTables:
    """The seven tables of a catalog schema, e.g. ``from_tables(spark, "clinical")``."""
    return ClinicalTables(**{t: spark.table(f"{schema}.{t}") for t in TABLE_NAMES})
