"""Slowly changing dimensions over three daily states of the customer table, and a history from the event log."""

from checks.base import Check, Checks, fresh_name, table
from dimflow.operators import scd
from dimflow.operators.splice import sightings
from dimflow.plans.pipeline import apply_scd
from dimflow.sources.tables import overwrite_table
from dimflow.spec import PipelineSpec, SourceSpec

CHECKS = Checks()

KEYS, TRACKED = ["id"], ["name", "department", "salary"]
DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")

# The customers of one segment join on day 2, those of another are gone by then; values change with the balance
_BASE = ("SELECT CAST(c_custkey AS INT) AS id, c_name AS name, c_mktsegment AS department, "
         "CAST(floor(c_acctbal) AS INT) AS salary FROM {customer}")
_STATES = (
    _BASE + " WHERE c_mktsegment <> 'HOUSEHOLD'",
    "SELECT id, name, CASE WHEN salary < 0 THEN 'CLOSED' WHEN salary > 9000 THEN NULL ELSE department END AS department, "
    "salary FROM (" + _BASE + " WHERE c_mktsegment <> 'FURNITURE')",
    "SELECT id, CASE WHEN salary > 8000 THEN upper(name) ELSE name END AS name, department, "
    "CASE WHEN salary < 2000 THEN salary + 100 ELSE salary END AS salary FROM (" + _BASE + ")",
)


def state(spark, sf_dir, day):
    return spark.sql(_STATES[day], customer=table(spark, sf_dir, "customer"))


def _sql(day):
    return f"({_STATES[day].format(customer='customer')})"


_ROW = "sha256(concat_ws('||', name, department, CAST(salary AS VARCHAR))) AS hash"
_ROWS = f"id, name, department, salary, {_ROW}"


def _stored(dim):
    return overwrite_table(dim, f"target.{fresh_name('dim')}")


@CHECKS.add(f"SELECT * FROM {_sql(0)} UNION ALL SELECT * FROM {_sql(1)} WHERE id NOT IN (SELECT id FROM {_sql(0)})")
def scd_type0(spark, sf_dir):
    return scd.scd0(_stored(state(spark, sf_dir, 0)), state(spark, sf_dir, 1), KEYS)


@CHECKS.add(f"SELECT {_ROWS} FROM {_sql(1)}")
def scd_type1_reload(spark, sf_dir):
    return scd.scd1_reload(state(spark, sf_dir, 1), TRACKED)


_UPSERT = (f"SELECT {_ROWS} FROM {_sql(1)} UNION ALL "
           f"SELECT {_ROWS} FROM {_sql(0)} WHERE id NOT IN (SELECT id FROM {_sql(1)})")


@CHECKS.add(_UPSERT)
def scd_type1_upsert(spark, sf_dir):
    dim = _stored(scd.scd1_reload(state(spark, sf_dir, 0), TRACKED))
    return scd.scd1_upsert(dim, state(spark, sf_dir, 1), KEYS, TRACKED)


@CHECKS.add(f"SELECT id, name, department, salary, DATE '2024-01-01' AS start_date, CAST(NULL AS DATE) AS end_date, "
            f"true AS is_current, {_ROW} FROM {_sql(0)}")
def scd_type2_initial(spark, sf_dir):
    return scd.scd2_initial(state(spark, sf_dir, 0), TRACKED, DAYS[0])


# the same history by another way: all daily states in one log, equal neighbours collapsed
_SNAPSHOTS = " UNION ALL ".join(f"SELECT *, DATE '{d}' AS start_date FROM {_sql(i)}" for i, d in enumerate(DAYS))
_HISTORY = f"""
WITH seen AS (
  SELECT *, lag(struct_pack(a := name, b := department, c := salary)) OVER (PARTITION BY id ORDER BY start_date) AS prior
  FROM ({_SNAPSHOTS})),
versions AS (
  SELECT id, name, department, salary, start_date FROM seen
  WHERE prior IS NULL OR prior IS DISTINCT FROM struct_pack(a := name, b := department, c := salary)),
history AS (
  SELECT *, lead(start_date) OVER (PARTITION BY id ORDER BY start_date) AS end_date FROM versions)
"""
_TYPE2 = (_HISTORY + f"SELECT id, name, department, salary, start_date, end_date, end_date IS NULL AS is_current, {_ROW} "
          "FROM history")


def _three_days(spark, sf_dir):
    dim = scd.scd2_initial(state(spark, sf_dir, 0), TRACKED, DAYS[0])
    for day in (1, 2):
        dim = scd.scd2_merge(_stored(dim), state(spark, sf_dir, day), KEYS, TRACKED, DAYS[day])
    return dim


@CHECKS.add(_TYPE2)
def scd_type2_merge(spark, sf_dir):
    return _three_days(spark, sf_dir)


@CHECKS.add(_TYPE2)
def scd_type2_idempotent(spark, sf_dir):
    return scd.scd2_merge(_stored(_three_days(spark, sf_dir)), state(spark, sf_dir, 2), KEYS, TRACKED, "2024-01-04")


@CHECKS.add(_TYPE2)
def scd_type2_table(spark, sf_dir):
    """The same three days as loads of a stored dimension."""
    name = fresh_name("customers")
    spec = PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}_dim", 2)
    for day in range(3):
        dim = apply_scd(overwrite_table(state(spark, sf_dir, day), spec.staging_table), spec, DAYS[day])
    return dim


def _loaded(spark, sf_dir, scd_type, days, **options):
    """The dimension after some days' loads by its type: the first days, or those listed in that order."""
    name = fresh_name("customers")
    spec = PipelineSpec(name, SourceSpec("csv", "unused"), f"staging.{name}", f"target.{name}_dim", scd_type, **options)
    for day in range(days) if isinstance(days, int) else days:
        dim = apply_scd(overwrite_table(state(spark, sf_dir, day), spec.staging_table), spec, DAYS[day])
    return dim


@CHECKS.add(f"SELECT * FROM {_sql(0)} UNION ALL SELECT * FROM {_sql(1)} WHERE id NOT IN (SELECT id FROM {_sql(0)})")
def scd_type0_table(spark, sf_dir):
    return _loaded(spark, sf_dir, 0, 2)


@CHECKS.add(f"SELECT {_ROWS} FROM {_sql(1)} UNION ALL "
            f"SELECT {_ROWS} FROM {_sql(0)} WHERE id NOT IN (SELECT id FROM {_sql(1)})")
def scd_type1_table(spark, sf_dir):
    return _loaded(spark, sf_dir, 1, 2, load="merge")


@CHECKS.add(f"SELECT {_ROWS} FROM {_sql(1)} UNION ALL "
            f"SELECT {_ROWS} FROM {_sql(0)} WHERE id NOT IN (SELECT id FROM {_sql(1)})")
def scd_type4_table(spark, sf_dir):
    return _loaded(spark, sf_dir, 4, 2)


@CHECKS.add(f"SELECT id, name, department, salary, DATE '2024-01-03' AS start_date, CAST(NULL AS DATE) AS end_date, "
            f"true AS is_current, {_ROW} FROM {_sql(2)}")
def scd_type2_reloaded(spark, sf_dir):
    """Loads that start the history anew."""
    return _loaded(spark, sf_dir, 2, 3, load="reload")


@CHECKS.add("""
WITH steps AS (
  SELECT user_id, event_type, ts, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prior
  FROM events),
kept AS (SELECT * FROM steps WHERE prior IS DISTINCT FROM event_type),
ended AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS end_at FROM kept)
SELECT user_id, event_type, ts AS start_at, end_at, end_at IS NULL AS is_current FROM ended""")
def scd_type2_from_log(spark, sf_dir):
    return scd.scd2_from_log(table(spark, sf_dir, "events"), ["user_id"], ["event_type"], ["ts", "event_id"])


def _prev(column):
    # the value before the last change, per column
    return f"""
  SELECT id, arg_max_null(before, start_date) AS prev_{column} FROM (
    SELECT id, start_date, {column}, lag({column}) OVER day AS before, row_number() OVER day AS nr
    FROM ({_SNAPSHOTS}) WINDOW day AS (PARTITION BY id ORDER BY start_date))
  WHERE nr > 1 AND before IS DISTINCT FROM {column} GROUP BY id"""


@CHECKS.add(f"""
SELECT id, name, department, salary, prev_name, prev_salary
FROM {_sql(2)} LEFT JOIN ({_prev('name')}) USING (id) LEFT JOIN ({_prev('salary')}) USING (id)""")
def scd_type3(spark, sf_dir):
    dim = scd.scd3_initial(state(spark, sf_dir, 0), ["name", "salary"])
    for day in (1, 2):
        dim = scd.scd3(_stored(dim), state(spark, sf_dir, day), KEYS, ["name", "salary"])
    return dim


@CHECKS.add(f"""
SELECT id, name, department, salary, prev_name, prev_department, prev_salary FROM {_sql(2)} LEFT JOIN ({_prev('name')}) USING (id)
LEFT JOIN ({_prev('department')}) USING (id) LEFT JOIN ({_prev('salary')}) USING (id)""")
def scd_type3_table(spark, sf_dir):
    return _loaded(spark, sf_dir, 3, 3)


def _type4(spark, sf_dir):
    dim = _stored(scd.scd1_reload(state(spark, sf_dir, 0), TRACKED))
    return scd.scd4(dim, state(spark, sf_dir, 1), KEYS, TRACKED, DAYS[1])


@CHECKS.add(_UPSERT)
def scd_type4_current(spark, sf_dir):
    return _type4(spark, sf_dir)[0]


@CHECKS.add(f"""
SELECT o.id, o.name, o.department, o.salary, sha256(concat_ws('||', o.name, o.department, CAST(o.salary AS VARCHAR))) AS hash,
       DATE '2024-01-02' AS valid_to
FROM {_sql(0)} o JOIN {_sql(1)} n USING (id)
WHERE (o.name, o.department, o.salary) IS DISTINCT FROM (n.name, n.department, n.salary)""")
def scd_type4_history(spark, sf_dir):
    return _type4(spark, sf_dir)[1]


@CHECKS.add(_HISTORY + f"""
SELECT id, name, department, salary, start_date, end_date, end_date IS NULL AS is_current, {_ROW},
       last_value(name) OVER all_v AS current_name, last_value(department) OVER all_v AS current_department,
       last_value(salary) OVER all_v AS current_salary, lag(name) OVER v AS prev_name,
       lag(department) OVER v AS prev_department, lag(salary) OVER v AS prev_salary
FROM history
WINDOW v AS (PARTITION BY id ORDER BY start_date),
       all_v AS (PARTITION BY id ORDER BY start_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def scd_type6(spark, sf_dir):
    dim = scd.scd6_initial(state(spark, sf_dir, 0), TRACKED, DAYS[0])
    for day in (1, 2):
        dim = scd.scd6(_stored(dim), state(spark, sf_dir, day), KEYS, TRACKED, DAYS[day])
    return dim


_TYPE6 = CHECKS[-1].sql
CHECKS.append(Check("scd_type6_table", lambda spark, sf_dir: _loaded(spark, sf_dir, 6, 3), _TYPE6))


def _out_of_order(spark, sf_dir, first, merge, days=(2, 0, 1)):
    """The three days in another order, with the sightings of the batches so far."""
    dim = seen = None
    for day in days:
        batch, date = state(spark, sf_dir, day), scd.load_date(DAYS[day])
        dim = first(batch, TRACKED, DAYS[day]) if dim is None else merge(_stored(dim), batch, KEYS, TRACKED, DAYS[day], seen=seen)
        sighted = sightings(batch, KEYS, date)
        seen = _stored(sighted if seen is None else seen.unionByName(sighted))
    return dim


@CHECKS.add(_TYPE2)
def scd_type2_late(spark, sf_dir):
    """The last day first, then the days before it."""
    return _out_of_order(spark, sf_dir, scd.scd2_initial, scd.scd2_merge)


@CHECKS.add(_TYPE2)
def scd_type2_late_table(spark, sf_dir):
    """The middle day last, as loads of a stored dimension."""
    return _loaded(spark, sf_dir, 2, (0, 2, 1), late_batches=True)


@CHECKS.add(_TYPE6)
def scd_type6_late(spark, sf_dir):
    return _out_of_order(spark, sf_dir, scd.scd6_initial, scd.scd6)


@CHECKS.add(_TYPE6)
def scd_type6_late_table(spark, sf_dir):
    return _loaded(spark, sf_dir, 6, (2, 0, 1), late_batches=True)


@CHECKS.add(f"""
SELECT id, CASE WHEN o.seen IS NULL THEN 'new' WHEN n.seen IS NULL THEN 'absent'
       WHEN (o.name, o.department, o.salary) IS DISTINCT FROM (n.name, n.department, n.salary) THEN 'changed'
       ELSE 'unchanged' END AS change
FROM (SELECT *, true AS seen FROM {_sql(0)}) o FULL JOIN (SELECT *, true AS seen FROM {_sql(1)}) n USING (id)""")
def scd_changes(spark, sf_dir):
    return scd.classify_changes(_stored(state(spark, sf_dir, 0)), state(spark, sf_dir, 1), KEYS, TRACKED)


@CHECKS.add(_HISTORY + "SELECT id, name, department, salary FROM history "
            "WHERE start_date <= DATE '2024-01-02' AND (end_date IS NULL OR end_date > DATE '2024-01-02')")
def scd_as_of(spark, sf_dir):
    return scd.as_of(_three_days(spark, sf_dir), "2024-01-02").select("id", "name", "department", "salary")


@CHECKS.add(CHECKS[-1].sql)
def scd_as_of_late(spark, sf_dir):
    """The state of a day in between, which was loaded last."""
    dim = _loaded(spark, sf_dir, 2, (0, 2, 1), late_batches=True)
    return scd.as_of(dim, "2024-01-02").select("id", "name", "department", "salary")
