from __future__ import annotations

import pytest
from conftest import day, rows

from indexday.sources import (
    ContractError,
    StageStore,
    Tables,
    check_relation,
    load_covariates,
    preview,
    read_stage,
    rows_without_date,
    run_sql,
    save_covariates,
    save_stage,
)
from indexday.sources.stages import shared_folder
from indexday.sources.tables import balanced_predicates, cuts_query, jdbc_options


def test_relation_contract(frame):
    good = frame([(1, 2, "x")], "ANCESTOR_CONCEPT_ID long, descendant_concept_id int, extra string")
    assert check_relation("concept_ancestor", good) is good
    with pytest.raises(ContractError, match="descendant_concept_id is missing"):
        check_relation("concept_ancestor", frame([(1,)], "ancestor_concept_id long"))


def test_timestamp_is_not_a_date(frame):
    stamped = frame([], "person_id long, measurement_concept_id int, measurement_date timestamp")
    with pytest.raises(ContractError, match="measurement_date is timestamp"):
        check_relation("measurement", stamped)


def test_rows_without_date(frame):
    df = frame([(day(0),), (None,), (None,)], "d date")
    assert rows_without_date(df, "d").first().d == 2


def test_tables_from_files_and_catalog(spark, frame, tmp_path):
    frame([(1, "X")], "location_id int, state string").write.parquet(str(tmp_path / "location"))
    tables = Tables.from_parquet(spark, str(tmp_path))
    assert rows(tables["location"]) == [(1, "X")]
    assert tables["location"] is tables.location
    with pytest.raises(KeyError):
        tables["lineitem"]
    spark.sql("create database if not exists claims")
    save_stage(tables["location"], "claims.location")
    assert rows(Tables.from_catalog(spark, "claims").location) == [(1, "X")]


def test_stage_is_written_once(spark, frame, tmp_path):
    target = str(tmp_path / "stage")
    assert rows(save_stage(frame([(1,)], "a int"), target)) == [(1,)]
    with pytest.raises(Exception, match="(?i)exists"):
        save_stage(frame([(2,)], "a int"), target)
    assert rows(read_stage(spark, target)) == [(1,)]


def test_stage_store_uses_the_named_folder(spark, frame):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    store = StageStore(spark)
    assert store.root.startswith(shared_folder(spark))
    store.put("s", frame([(7,)], "a int"))
    assert rows(store.get("s")) == [(7,)]


def test_stages_as_named_tables(spark, frame):
    spark.sql("create database if not exists study")
    store = StageStore(spark, schema="study", names={"cohort": "my_cohort"})
    store.put("cohort", frame([(3,)], "a int"))
    assert rows(spark.table("study.my_cohort")) == rows(store.get("cohort")) == [(3,)]
    with pytest.raises(Exception, match="(?i)exists"):
        store.put("cohort", frame([(4,)], "a int"))


def test_bucketed_events_need_no_exchange(spark, frame):
    df = frame([(1, 2), (1, 3), (2, 4)], "person_id long, v int")
    stored = save_stage(df, "events_by_person", mode="overwrite", bucket=(4, "person_id"))
    plan = stored.groupBy("person_id").max("v")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_preview(frame):
    assert preview(frame([(i,) for i in range(9)], "a int")).count() == 5


def test_covariate_file(spark, frame, tmp_path):
    path = str(tmp_path / "covariates")
    save_covariates(frame([(1, 2, 3.0, "x")], "rowId long, covariateId long, covariateValue double, note string"), path)
    assert rows(load_covariates(spark, path)) == [(1, 2, 3.0)]
    frame([(1,)], "rowId long").write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="covariateId"):
        load_covariates(spark, str(tmp_path / "other"))


def test_sql_with_frames_values_and_table_names(spark, frame):
    people = frame([(1, 1950), (2, 1970)], "id long, born int")
    out = run_sql(spark, "select id from {people} where born > :year", {"people": people}, {"year": 1960})
    assert rows(out) == [(2,)]
    save_stage(people, "sql_people", mode="overwrite")
    assert rows(run_sql(spark, "select count(*) from IDENTIFIER(:t)", args={"t": "sql_people"})) == [(2,)]


def test_stage_is_dropped(spark, frame, tmp_path):
    store = StageStore(spark, root=str(tmp_path))
    store.put("one", frame([(1,)], "x int"))
    store.put("two", frame([(2,)], "x int"))
    store.drop("one", "never_written")
    assert not (tmp_path / "one").exists() and rows(store.get("two")) == [(2,)]


def test_jdbc_options_per_table():
    common = {"url": "jdbc:x", "fetchsize": "10"}
    own = {"partitionColumn": "person_id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    merged = jdbc_options("s", "person", common, own | {"fetchsize": "99"})
    assert merged == {"url": "jdbc:x", "dbtable": "s.person", **own, "fetchsize": "99"}
    assert jdbc_options("s", "concept", common, {}) == {**common, "dbtable": "s.concept"}
    with pytest.raises(ValueError, match="person: a partitioned read needs"):
        jdbc_options("s", "person", common, {"partitionColumn": "person_id"})


def test_balanced_predicates_deal_every_row_once(tmp_path):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("create schema s")
    # a third of all rows hold one key; some hold none
    con.execute("""create table s.events as select case when i % 3 = 0 then 500 when i % 50 = 1 then null else (i * i) % 9973 end as person_id,
                          i as n from range(30000) r(i)""")
    for parts in (1, 2, 16, 64):
        cuts = [c for _, c in con.execute(f"select * from {cuts_query('s.events', 'person_id', parts)}").fetchall()]
        where = balanced_predicates("person_id", cuts)
        counts = [con.execute(f"select count(*) from s.events where {w}").fetchone()[0] for w in where]
        assert sum(counts) == 30000 and len(where) <= parts
        hot = con.execute("select count(*) from s.events where person_id = 500").fetchone()[0]
        assert max(counts) <= max(2 * 30000 / parts + 1000, hot + 2 * 30000 / parts + 1000)
        ids = [n for w in where for (n,) in con.execute(f"select n from s.events where {w}").fetchall()]
        assert sorted(ids) == list(range(30000))


def test_balanced_predicates_by_type():
    assert balanced_predicates("k", []) == balanced_predicates("k", [3, 3]) == ["1 = 1"]
    assert balanced_predicates("k", [9, 1, 5, 5]) == ["(k < 5 OR k IS NULL)", "k >= 5 AND k < 9", "k >= 9"]
    assert balanced_predicates("d", [day(0), day(31)])[-1] == "d >= DATE '2020-02-01'"
    assert balanced_predicates("t", ["a", "o'b"])[-1] == "t >= 'o''b'"
    with pytest.raises(ValueError, match="no key value"):
        balanced_predicates("k", [False, True])


def test_jdbc_reads_balanced_parts(frame):
    asked = []

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            return frame([(1, 10), (2, 40), (3, 90)], "part int, cut int")

        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))
            return frame([], "location_id int, state string")

    class Session:
        read = Reader()

    tables = Tables.from_jdbc(Session(), "s", balanced={"location": ("location_id", 3)}, url="jdbc:x", fetchsize="10")
    assert tables.location.columns == ["location_id", "state"]
    assert asked[0] == {"url": "jdbc:x", "fetchsize": "10", "dbtable": cuts_query("s.location", "location_id", 3)}
    parts = ["(location_id < 40 OR location_id IS NULL)", "location_id >= 40 AND location_id < 90", "location_id >= 90"]
    assert asked[1] == ("jdbc:x", "s.location", parts, {"fetchsize": "10"})
    with pytest.raises(KeyError):
        Tables.from_jdbc(Session(), "s", balanced={"lineitem": ("k", 2)}, url="jdbc:x")
    own = {"partitionColumn": "location_id", "lowerBound": "0", "upperBound": "9", "numPartitions": "2"}
    with pytest.raises(ValueError, match="either"):
        Tables.from_jdbc(Session(), "s", per_table={"location": own}, balanced={"location": ("location_id", 3)}, url="jdbc:x")


def test_counts_come_from_the_write(spark, frame):
    store = StageStore(spark)
    store.put("some", frame([(i,) for i in range(17)], "a int"), counted=True)
    store.put("none", frame([], "a int"), counted=True)
    store.put("unknown", frame([(1,)], "a int"))
    assert store.counts == {"some": 17, "none": 0}
