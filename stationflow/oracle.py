"""Equivalent SQL for the registered queries, written from the definitions and not from the plans.

Whole-number arithmetic stands in for decimal rounding, and ranks from `row_number` for
percentiles, so that the two engines agree to the last digit.
"""

from __future__ import annotations

from stationflow.sources.faults import KINDS
from stationflow.sources.star import BATCH_MESSAGES, CUT_LINE, MENDED_HOUR, NO_TTL, PLACES, REPEATED_POLL, STATIONS

ZONE = "Europe/Paris"

MESSAGES = f"""
msg as (
  select event_id as status_id,
         lpad(cast(user_id % {STATIONS} as varchar), 3, '0') as station_id,
         date_trunc('minute', ts) as last_reported,
         cast(floor(value) as int) % {PLACES + 1} as bikes,
         {PLACES} - cast(floor(value) as int) % {PLACES + 1} as docks,
         event_type <> 'signup' as is_installed,
         date_trunc('minute', ts) as feed_last_updated,
         ts as fetched_at,
         ts + interval 3 second as ingested_at,
         event_type = 'error' as is_replay
  from events
)"""

RAW = (
    MESSAGES
    + """,
ranked as (
  select *, row_number() over (partition by station_id, last_reported order by status_id) as rn from msg
),
raw as (select * exclude (rn) from ranked where rn = 1)"""
)

DIM = """
dim as (
  select lpad(cast(n_nationkey as varchar), 3, '0') as station_id, n_name as nom,
         43.4 + n_nationkey / 50.0 as lat, 3.6 + n_regionkey / 10.0 as lon, 8 + n_regionkey as capacite
  from nation
)"""

FACT = (
    RAW
    + ","
    + DIM
    + f""",
fact as (
  select raw.*, d.capacite as capacity,
         (raw.last_reported at time zone 'UTC') at time zone '{ZONE}' as local_ts,
         date_trunc('hour', (raw.last_reported at time zone 'UTC') at time zone '{ZONE}') as local_hour,
         case when bikes + docks > 0 then cast(bikes as double) / (bikes + docks) end as fill,
         is_installed and bikes = 0 as empty_, is_installed and docks = 0 as full_
  from raw left join dim d using (station_id)
)"""
)


def half_up(total: str, count: str, places: int) -> str:
    """total / count, both whole and not negative, rounded half up to `places`."""
    one = 10**places
    return (
        f"cast((2 * cast({total} as hugeint) * {one} + ({count})) // (2 * cast({count} as hugeint)) as double) / {one}"
    )


TEN = 10**10
RATIO_SUM = f"sum((2 * cast(bikes as hugeint) * {TEN} + (bikes + docks)) // (2 * (bikes + docks)))"


def measures(bikes_name: str) -> str:
    return f"""
  {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as taux_remplissage_moyen,
  {half_up("sum(bikes)", "count(*)", 2)} as {bikes_name},
  {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_releves_vide,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_releves_pleine"""


NETWORK = (
    FACT
    + f""",
net as (
  select local_hour, count(distinct station_id) as nb_stations, count(*) as nb_releves,
         {measures("velos_moyens_par_station")}
  from fact group by local_hour
)"""
)

RANKING = (
    FACT
    + f""",
ranking as (
  select d.station_id, d.nom, cast(d.capacite as int) as capacite, count(*) as nb_releves,
         min(last_reported) as premier, max(last_reported) as dernier,
         {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_temps_vide,
         {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_temps_pleine,
         {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as taux_remplissage_moyen
  from fact join dim d using (station_id)
  group by d.station_id, d.nom, d.capacite
)"""
)

LEDGER = (
    RAW
    + f""",
ledger as (
  select m.status_id // {BATCH_MESSAGES} as batch_id, min(m.ingested_at) as started_at,
         max(m.ingested_at) as finished_at, count(*) as received, count(*) as status_valid,
         count(r.status_id) as inserted, count(*) - count(r.status_id) as duplicates
  from msg m left join raw r on r.status_id = m.status_id
  group by 1
)"""
)


def iso(ts: str, zoned: bool = True) -> str:
    end = "+00:00" if zoned else ""
    return (
        f"case when epoch_us({ts}) % 1000000 = 0 then strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"else strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') end || '{end}'"
    )


def seconds(micros_times_10000: str, places: int) -> str:
    """Microseconds, held as whole ten-thousandths, as seconds rounded half up."""
    return half_up(micros_times_10000, "cast(10000000000 as hugeint)", places)


def rank_value(values: str, p: float, groups: str = "") -> str:
    """Interpolated percentile of whole values as ten-thousandths, from a sorted list."""
    scaled = round(p * 10000)
    at = f"({scaled} * (len({values}) - 1))"
    low = f"{values}[{at} // 10000 + 1]"
    high = f"{values}[least({at} // 10000 + 2, len({values}))]"
    return f"(cast({low} as hugeint) * 10000 + ({high} - {low}) * ({at} % 10000))"


def micros(later: str, earlier: str) -> str:
    return f"(epoch_us({later}) - epoch_us({earlier}))"


E2E = micros("ingested_at", "last_reported")
PIPE = micros("ingested_at", "fetched_at")
AGE = micros("fetched_at", "last_reported")
BUCKET = "time_bucket(interval 5 minute, ingested_at)"


def latency_case(since: str) -> str:
    """Latency in seconds with three places, null for a replayed reading."""
    return f"case when not is_replay then {half_up(micros('ingested_at', since), '1000000', 3)} end"


FACT_COLUMNS = f"""
  status_id, station_id, {iso("last_reported")} as last_reported,
  {iso("local_ts", False)} as releve_heure_locale, {iso("local_hour", False)} as heure_locale,
  bikes as num_bikes_available, docks as num_docks_available, cast(capacity as int) as capacity,
  is_installed, true as is_renting, true as is_returning, fill as taux_remplissage,
  empty_ as est_vide, full_ as est_pleine,
  {latency_case("last_reported")} as latence_bout_en_bout_s,
  {latency_case("fetched_at")} as latence_pipeline_s,
  is_replay, {iso("ingested_at")} as ingested_at"""

READING_COLUMNS = f"""
  status_id, station_id, {iso("last_reported")} as last_reported, bikes as num_bikes_available,
  docks as num_docks_available, is_installed, is_replay, {iso("fetched_at")} as fetched_at"""

MONTH = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")
RANGE = ("2024-01-08 07:31:30", "2024-01-23 19:12:08")
# When the first of several batches is written, and a time range that holds only the one an hour later.
FIRST_BATCH = "2024-02-01 00:00:00"
MIDDLE_BATCH = ("2024-02-01 00:30:00", "2024-02-01 01:30:00")
AS_OF = "2024-01-30 23:59:59"
FRESH_AS_OF = "2024-01-31 00:00:00"


def in_range(column: str, ends: tuple[str, str] = RANGE) -> str:
    return f"{column} between timestamp '{ends[0]}' and timestamp '{ends[1]}'"


def batch_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dedup_first"] = f"with {RAW} select {READING_COLUMNS} from raw"
    q["dedup_last_position"] = f"""
with {MESSAGES}, p as (
  select *, row_number() over (partition by station_id, last_reported order by status_id) as rn,
         max(status_id) over (partition by station_id, last_reported) as last_id from msg)
select station_id, {iso("last_reported")} as last_reported, bikes as num_bikes_available,
       last_id as kafka_offset from p where rn = 1"""
    q["ingest_ledger"] = f"""
with {LEDGER} select batch_id, {iso("started_at")} as started_at, {iso("finished_at")} as finished_at,
  received, cast(0 as bigint) as invalid, status_valid, inserted as status_inserted,
  duplicates as status_duplicates, cast(0 as bigint) as information_upserted from ledger"""
    q["latest_description"] = """
select user_id as key, arg_max(props, event_id) as description, max(event_id) as position from events group by 1"""
    q["description_changes"] = """
with p as (select user_id, event_id, props, lag(props) over (partition by user_id order by event_id) as prev from events)
select user_id as key, event_id as position, props as description from p where prev is distinct from props"""
    q["staged_readings"] = f"""
with {RAW} select status_id, station_id, {iso("last_reported")} as last_reported,
  {latency_case("last_reported")} as latence_bout_en_bout_s,
  {latency_case("fetched_at")} as latence_pipeline_s, is_replay from raw"""
    q["station_dimension"] = f"""
with {DIM} select station_id, nom, cast(lat as double) as lat, cast(lon as double) as lon,
  cast(capacite as int) as capacite, false as station_virtuelle,
  '2024-01-01T00:00:00+00:00' as description_maj_le from dim"""
    q["fact_readings"] = f"with {FACT} select {FACT_COLUMNS} from fact"
    q["fact_incremental"] = f"""
with {FACT}, mark as (select max(status_id) as hwm from raw where last_reported < timestamp '2024-01-16')
select {FACT_COLUMNS}, case when status_id > hwm then 2 else 1 end as load from fact, mark"""
    q["agg_station_hour"] = f"""
with {FACT} select station_id, {iso("local_hour", False)} as heure_locale, count(*) as nb_releves,
  {measures("velos_moyens")} from fact group by station_id, local_hour"""
    q["agg_network_hour"] = f"with {NETWORK} select * exclude (local_hour), {iso('local_hour', False)} as heure_locale from net"
    q["station_ranking"] = f"""
with {RANKING} select * exclude (premier, dernier), {iso("premier")} as premier_releve,
  {iso("dernier")} as dernier_releve from ranking"""
    q["hour_of_day"] = f"""
with {NETWORK}, h as (select cast(extract(hour from local_hour) as int) as heure_du_jour, count(*) as heures_observees,
  sum(cast(round(taux_remplissage_moyen * 10000) as bigint)) as a,
  sum(cast(round(part_releves_vide * 10000) as bigint)) as b,
  sum(cast(round(part_releves_pleine * 10000) as bigint)) as c from net group by 1)
select heure_du_jour, heures_observees, {half_up("a", "heures_observees * 10000", 4)} as taux_remplissage_moyen,
  {half_up("b", "heures_observees * 10000", 4)} as part_releves_vide,
  {half_up("c", "heures_observees * 10000", 4)} as part_releves_pleine from h"""
    q["hourly_occupation"] = f"""
with {NETWORK} select * exclude (local_hour), strftime(local_hour, '%Y-%m-%d %H:00') as heure_locale from net"""
    q["latency_percentiles"] = f"""
with {RAW}, l as (select list_sort(list({E2E})) as e, list_sort(list({PIPE})) as p, list_sort(list({AGE})) as a,
  count(*) as n from raw where not is_replay)
select n, {seconds(rank_value("e", 0.5), 2)} as bout_en_bout_p50_s,
  {seconds(rank_value("e", 0.95), 2)} as bout_en_bout_p95_s,
  {seconds("e[len(e)] * cast(10000 as hugeint)", 2)} as bout_en_bout_max_s,
  {seconds(rank_value("p", 0.5), 3)} as pipeline_p50_s, {seconds(rank_value("p", 0.95), 3)} as pipeline_p95_s,
  {seconds(rank_value("a", 0.5), 2)} as age_flux_a_la_lecture_p50_s from l"""
    q["snapshot_gaps"] = f"""
with {RAW}, s as (select distinct feed_last_updated as t from raw where not is_replay),
g as (select {micros("t", "lag(t) over (order by t)")} as gap from s),
l as (select count(*) as n, count(*) filter (where gap > 90000000) as big, list_sort(list(gap)) as v from g where gap is not null)
select n as intervalles, big as intervalles_superieurs_90s, {seconds(rank_value("v", 0.5), 1)} as ecart_median_s,
  {seconds("v[len(v)] * cast(10000 as hugeint)", 1)} as ecart_max_s from l"""
    q["ingest_series_5min"] = f"""
with {RAW}, l as (select {BUCKET} as b, count(*) as releves_inseres,
  count(*) filter (where not is_replay) as releves_temps_reel,
  list_sort(list({E2E}) filter (where not is_replay)) as e,
  list_sort(list({PIPE}) filter (where not is_replay)) as p from raw group by 1)
select strftime(b, '%Y-%m-%d %H:%M') as tranche_5min, releves_inseres, releves_temps_reel,
  {seconds(rank_value("e", 0.5), 2)} as latence_bout_en_bout_p50_s,
  {seconds(rank_value("e", 0.95), 2)} as latence_bout_en_bout_p95_s,
  {seconds(rank_value("p", 0.95), 3)} as latence_pipeline_p95_s from l"""
    q["snapshot_series"] = f"""
with {FACT} select strftime(last_reported, '%Y-%m-%d %H:%M:%S') as instantane_utc, count(*) as stations,
  {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_vides,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_pleines from fact group by 1"""
    q["global_shares"] = f"""
with {FACT} select {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_releves_vide,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_releves_pleine,
  {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as taux_remplissage_moyen,
  count(*) filter (where bikes > capacity) as releves_velos_superieurs_capacite from fact"""
    q["stations_by_emptiness"] = f"with {RANKING} select * exclude (premier, dernier) from ranking"
    q["overview"] = f"""
with {LEDGER}, l as (select * from raw where not is_replay)
select (select count(*) from nation) as stations_decrites,
  (select count(distinct station_id) from l) as stations_observees,
  (select {iso("min(ingested_at)")} from l) as debut_collecte,
  (select {iso("max(ingested_at)")} from l) as fin_collecte,
  (select {half_up(micros("max(ingested_at)", "min(ingested_at)"), "cast(3600000000 as hugeint)", 2)} from l) as duree_collecte_h,
  (select cast(sum(received) as bigint) from ledger) as messages_recus,
  (select cast(sum(status_valid) as bigint) from ledger) as messages_statut_valides,
  (select cast(sum(inserted) as bigint) from ledger) as releves_inseres,
  (select cast(sum(duplicates) as bigint) from ledger) as doublons_ecartes,
  cast(0 as bigint) as messages_invalides,
  (select count(*) from ledger) as lots_ecrits,
  (select count(*) from l) as lignes_station_status,
  (select count(distinct last_reported) from l) as instantanes_distincts"""

    q["dq_orphans"] = f"with {RAW}, {DIM} select station_id, count(*) as n from raw where station_id not in (select station_id from dim) group by 1"
    q["dq_over_capacity"] = f"""
with {FACT} select status_id, station_id, bikes as num_bikes_available, cast(capacity as int) as capacity
from fact where bikes > capacity"""
    q["dq_not_null"] = f"with {FACT} select status_id, station_id from fact where capacity is null"
    q["dq_unique"] = f"with {MESSAGES} select station_id, count(*) as n from msg where station_id is not null group by 1 having count(*) > 1"
    q["dq_unique_combo"] = f"""
with {MESSAGES} select station_id, {iso("last_reported")} as last_reported, count(*) as n from msg
group by station_id, msg.last_reported having count(*) > 1"""
    q["dq_range"] = f"with {DIM} select station_id, cast(lat as double) as lat from dim where lat < 43.4 or lat > 43.8"
    q["dq_relationships"] = f"""
with {FACT} select status_id, station_id from fact where station_id not in (select station_id from dim)"""
    q["dq_suite"] = _suite_sql()
    q["freshness"] = f"""
with {RAW}, m as (select max(ingested_at) as newest from raw)
select {iso("newest")} as newest,
  cast(floor(epoch(timestamp '{FRESH_AS_OF}')) - floor(epoch_us(newest) / 1000000) as bigint) as age_s,
  case when timestamp '{FRESH_AS_OF}' - newest > interval 15 minute then 'error'
       when timestamp '{FRESH_AS_OF}' - newest > interval 5 minute then 'warn' else 'pass' end as status from m"""

    q["panel_messages"] = f"""
with {LEDGER} select cast(coalesce(sum(status_valid), 0) as bigint) as messages from ledger where {in_range("finished_at", MONTH)}"""
    q["panel_duplicates"] = f"""
with {LEDGER} select cast(coalesce(sum(duplicates), 0) as bigint) as doublons from ledger where {in_range("finished_at")}"""
    q["panel_stations"] = f"""
with {RAW} select count(distinct station_id) as stations from raw
where ingested_at > timestamp '{AS_OF}' - interval 10 minute"""
    q["panel_inserted_5min"] = f"""
with {RAW}, b as (select {BUCKET} as t, count(*) as n from raw where not is_replay and {in_range("ingested_at", MONTH)} group by 1)
select {iso("t")} as time, n as releves_inseres from b"""
    q["panel_latency_5min"] = f"""
with {RAW}, b as (select {BUCKET} as t, list_sort(list({E2E})) as e, list_sort(list({PIPE})) as p
  from raw where not is_replay and {in_range("ingested_at", MONTH)} group by 1)
select {iso("t")} as time, {seconds(rank_value("e", 0.5), 6)} as p50, {seconds(rank_value("e", 0.95), 6)} as p95,
  {seconds(rank_value("p", 0.95), 6)} as p95_pipeline from b"""
    q["panel_shares"] = f"""
with {FACT} select {iso("last_reported")} as time,
  cast(count(*) filter (where empty_) as double) / count(*) as vides,
  cast(count(*) filter (where full_) as double) / count(*) as pleines
from fact where {in_range("last_reported", MONTH)} group by fact.last_reported"""
    q["panel_fill_per_hour"] = f"""
with {NETWORK} select strftime(local_hour, '%d/%m %Hh') as heure, taux_remplissage_moyen as remplissage from net"""
    return q


def _suite_sql() -> str:
    """The whole test suite, one select for each test."""

    def rows(test: str, model: str, column: str, failures: str) -> str:
        return f"select '{test}' as test, '{model}' as model, '{column}' as \"column\", ({failures}) as failures"

    def null_count(table: str, column: str) -> str:
        return f"select count(*) from {table} where {column} is null"

    def repeats(table: str, column: str) -> str:
        return f"select count(*) from (select {column} from {table} group by {column} having count(*) > 1)"

    def outside(table: str, condition: str) -> str:
        return f"select count(*) from {table} where {condition}"

    parts = [
        rows("unique", "station_status", "status_id", repeats("raw", "status_id")),
        rows("not_null", "station_status", "status_id", null_count("raw", "status_id")),
        rows("unique", "station_information", "station_id", repeats("dim", "station_id")),
        rows("not_null", "station_information", "station_id", null_count("dim", "station_id")),
        rows("unique", "stg_station_status", "status_id", repeats("raw", "status_id")),
        rows("not_null", "stg_station_status", "status_id", null_count("raw", "status_id")),
        rows("not_null", "stg_station_status", "station_id", null_count("raw", "station_id")),
        rows("not_null", "stg_station_status", "last_reported", null_count("raw", "last_reported")),
        rows("not_null", "stg_station_status", "num_bikes_available", null_count("raw", "bikes")),
        rows("not_null", "stg_station_status", "num_docks_available", null_count("raw", "docks")),
        rows("accepted_range", "stg_station_status", "num_bikes_available", outside("raw", "bikes < 0")),
        rows("accepted_range", "stg_station_status", "num_docks_available", outside("raw", "docks < 0")),
        rows("accepted_range", "stg_station_status", "latence_pipeline_s", outside("raw", "not is_replay and ingested_at < fetched_at")),
        rows("unique", "stg_station_information", "station_id", repeats("dim", "station_id")),
        rows("not_null", "stg_station_information", "station_id", null_count("dim", "station_id")),
        rows("not_null", "stg_station_information", "capacite", null_count("dim", "capacite")),
        rows("accepted_range", "stg_station_information", "capacite", outside("dim", "capacite < 0 or capacite > 200")),
        rows("accepted_range", "stg_station_information", "lat", outside("dim", "lat < 43.4 or lat > 43.8")),
        rows("accepted_range", "stg_station_information", "lon", outside("dim", "lon < 3.6 or lon > 4.2")),
        rows("unique", "dim_station", "station_id", repeats("dim", "station_id")),
        rows("not_null", "dim_station", "station_id", null_count("dim", "station_id")),
        rows("not_null", "dim_station", "capacite", null_count("dim", "capacite")),
        rows("unique_combination", "fct_station_status", "station_id, last_reported", repeats("fact", "station_id, last_reported")),
        rows("unique", "fct_station_status", "status_id", repeats("fact", "status_id")),
        rows("not_null", "fct_station_status", "status_id", null_count("fact", "status_id")),
        rows("not_null", "fct_station_status", "station_id", null_count("fact", "station_id")),
        rows("relationships", "fct_station_status", "station_id", outside("fact", "station_id not in (select station_id from dim)")),
        rows("accepted_range", "fct_station_status", "taux_remplissage", outside("fact", "fill < 0 or fill > 1")),
        rows(
            "accepted_range",
            "agg_occupation_horaire",
            "part_releves_vide",
            "select count(*) from (select count(*) filter (where empty_) as e, count(*) as n from fact "
            "group by station_id, local_hour) where e > n",
        ),
        rows("unique", "agg_reseau_horaire", "heure_locale", repeats("net", "local_hour")),
        rows("not_null", "agg_reseau_horaire", "heure_locale", null_count("net", "local_hour")),
        rows("unique", "stations_vides_pleines", "station_id", repeats("ranking", "station_id")),
        rows("not_null", "stations_vides_pleines", "station_id", null_count("ranking", "station_id")),
        rows(
            "described_stations",
            "stg_station_status",
            "station_id",
            "select count(distinct station_id) from raw where station_id not in (select station_id from dim)",
        ),
        rows("bikes_within_capacity", "fct_station_status", "num_bikes_available", outside("fact", "bikes > capacity")),
    ]
    marts = NETWORK + RANKING[len(FACT):]
    return (
        f"with {marts}, verdicts as ({' union all '.join(parts)}) "
        "select *, case when failures = 0 then 'pass' else 'fail' end as status from verdicts"
    )


def _verdicts() -> str:
    """Each message with the error its kind must give, known from how it was built."""
    quoted = {k: kind.error.replace("'", "''") for k, kind in enumerate(KINDS) if kind.error}
    cases = " ".join(f"when {k} then '{error}'" for k, error in quoted.items())
    topics = " ".join(f"when {k} then '{kind.topic}'" for k, kind in enumerate(KINDS))
    digits = [str(k) for k, kind in enumerate(KINDS) if not kind.error and kind.fields]
    return f"""{MESSAGES}, mixed as (
  select *, case status_id % {len(KINDS)} {cases} end as error, case status_id % {len(KINDS)} {topics} end as topic,
    status_id % {len(KINDS)} in ({", ".join(digits)}) as as_digits from msg)"""


def _archive_sql() -> str:
    """Distinct snapshots are the minutes with a reading; every seventh minute is polled twice."""
    return f"""{FACT}, shots as (
  select last_reported as t, epoch_us(max(fetched_at)) - epoch_us(last_reported) as age,
    (epoch_us(last_reported) // 60000000) % {REPEATED_POLL} = 0 as twice
  from fact group by last_reported)"""


def streamed_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    flat = batch_sql()
    q["description_changes_stream"] = flat["description_changes"]
    q["model_build"] = flat["agg_network_hour"]
    mended = f"(is_installed or extract(hour from raw.last_reported) = {MENDED_HOUR}) and"
    q["model_redelivered"] = flat["agg_network_hour"].replace("is_installed and", mended)
    q["dq_suite_built"] = flat["dq_suite"]
    q["fact_redelivered"] = f"with {FACT} select status_id, station_id, cast(coalesce(capacity, {PLACES}) as int) as capacity from fact"
    q["validate_messages"] = f"""
with {_verdicts()} select topic, status_id as kafka_offset, error,
  case when topic = 'station_status' and error is null then station_id end as status_station,
  case when topic = 'station_status' and error is null then not as_digits end as is_renting,
  case when topic = 'station_information' and error is null then 'Station ' || station_id end as name from mixed"""
    q["ingest_stream"] = f"""
with {RAW} select row_number() over (order by raw.status_id) as status_id, station_id, {iso("last_reported")} as last_reported,
  bikes as num_bikes_available, docks as num_docks_available, is_installed, is_replay,
  raw.status_id as kafka_offset from raw"""
    for name in ("ingest_stream_resent", "ingest_stream_compacted", "ingest_stream_many_batches"):
        q[name] = q["ingest_stream"]
    q["ingest_stream_ledger"] = f"""
with {_verdicts()}, good as (select * from mixed where topic = 'station_status' and error is null)
select (select count(*) from mixed) as received, (select count(*) from mixed where error is not null) as invalid,
  (select count(*) from good) as status_valid,
  (select count(*) from (select distinct station_id, last_reported from good)) as status_inserted,
  (select count(*) from good) - (select count(*) from (select distinct station_id, last_reported from good)) as status_duplicates,
  (select count(*) from mixed where topic = 'station_information' and error is null) as information_upserted"""
    q["ingest_stream_rejected"] = f"""
with {_verdicts()} select row_number() over (order by status_id) as rejected_id, topic, status_id as kafka_offset, error
from mixed where error is not null"""
    q["ingest_stream_information"] = f"""
with {_verdicts()}, good as (select * from mixed where topic = 'station_information' and error is null)
select station_id, 'Station ' || station_id as name, cast(43.6 as double) as lat, cast(3.9 as double) as lon,
  arg_max(bikes, status_id) as capacity, max(status_id) as kafka_offset from good group by station_id"""
    # The second of three parts by offset.
    second = "status_id > (select max(event_id) // 3 from events) and status_id <= (select max(event_id) * 2 // 3 from events)"
    q["panel_rejected"] = f"with {_verdicts()} select count(*) as rejetes from mixed where error is not null and {second}"
    q["panel_inserted_hour"] = f"""
with {_verdicts()}, firsts as (
  select min(status_id) as status_id from mixed where topic = 'station_status' and error is null group by station_id, last_reported)
select {iso("timestamp '2024-02-01 01:00:00'")} as time, count(*) as releves_inseres from firsts where {second}"""
    q["live_series_5min"] = f"""
with {MESSAGES}, b as (select {BUCKET} as t, count(*) as messages, count(distinct station_id) as stations from msg group by 1)
select {iso("t")} as time, messages, stations from b"""
    q["archive_replay"] = f"""
with {RAW} select station_id, {iso("last_reported")} as last_reported, bikes as num_bikes_available,
  docks as num_docks_available, is_installed, true as is_replay from raw"""
    q["archive_scan"] = f"""
with {_archive_sql()}, minutes as (
  select t, twice, (epoch_us(t) // 60000000) as number, (select count(*) from fact f where f.last_reported = shots.t) as readings,
    'station_status_' || strftime(t, '%Y-%m-%d') || case when day(t) % 2 = 1 then '.jsonl.gz' else '.jsonl' end as file_name from shots),
lines as (
  select file_name, 'good' as line, 1 + twice::int as n, readings from minutes
  union all select file_name, 'cut', 1, 0 from minutes where number % {CUT_LINE} = 0
  union all select file_name, 'without ttl', 1, readings from minutes where number % {NO_TTL} = 0
  union all select 'station_information_2024-01-01.jsonl', 'good', 1, (select count(*) from dim)),
judged as (
  select reading, file_name, n, readings, case when line = 'cut' then 'line is not JSON'
    when line = 'without ttl' and reading = 'replay' then 'incomplete envelope: ttl' end as source_error
  from lines, (values ('replay'), ('analysis')) r(reading))
select reading, file_name, source_error, cast(sum(n) as bigint) as lines,
  cast(sum(case when source_error is null then n * readings else 0 end) as bigint) as stations from judged group by all"""
    q["archive_hourly"] = f"""
with {FACT} select strftime(local_hour, '%Y-%m-%d %H:%M') as heure_locale, count(distinct station_id) as nb_stations,
  count(*) as nb_releves, {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as taux_remplissage_moyen,
  {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_releves_vide,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_releves_pleine from fact group by local_hour"""
    q["archive_network_series"] = f"""
with {FACT} select strftime(local_ts, '%Y-%m-%d %H:%M:%S') as horodatage_local,
  cast(sum(bikes) as bigint) as velos_disponibles, cast(sum(docks) as bigint) as bornes_libres,
  count(*) filter (where empty_) as stations_vides, count(*) filter (where full_) as stations_pleines
from fact group by local_ts"""
    q["archive_stations"] = f"""
with {FACT} select station_id, coalesce(max(d.nom), '') as nom, cast(max(d.capacite) as bigint) as capacite,
  count(*) as nb_releves, {half_up("count(*) filter (where empty_)", "count(*)", 4)} as part_temps_vide,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as part_temps_pleine,
  {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as taux_remplissage_moyen
from fact left join dim d using (station_id) group by station_id"""
    q["top_empty_stations"] = f"""
with stations as ({q["archive_stations"]})
select coalesce(nullif(left(nom, 34), ''), station_id) as station, cast(round(part_temps_vide * 10000) as double) / 100 as part_vide_pct
from stations order by part_temps_vide desc, station_id limit 12"""
    q["archive_overview"] = f"""
with {_archive_sql()}, g as (select {micros("t", "lag(t) over (order by t)")} as gap from shots),
gl as (select list_sort(list(gap)) as v, count(*) filter (where gap > 90000000) as big from g where gap is not null),
al as (select list_sort(list(age)) as v, count(*) as n, count(*) filter (where twice) as again, min(t) as lo, max(t) as hi from shots),
f as (select count(*) as n, count(distinct station_id) as stations,
  {half_up("count(*) filter (where empty_)", "count(*)", 4)} as e,
  {half_up("count(*) filter (where full_)", "count(*)", 4)} as p,
  {half_up(RATIO_SUM, f"count(*) * cast({TEN} as hugeint)", 4)} as r,
  count(*) filter (where bikes > capacity) as over_ from fact)
select 'archived feed snapshots, without the pipeline' as source,
  (select count(*) from dim) as stations_decrites, f.stations as stations_observees,
  al.n + al.again as interrogations, al.n as instantanes_distincts, al.again as interrogations_redondantes,
  f.n as releves_station, {iso("lo")} as debut_utc, {iso("hi")} as fin_utc,
  {half_up(micros("hi", "lo"), "cast(3600000000 as hugeint)", 2)} as duree_h,
  {seconds(rank_value("gl.v", 0.5), 1)} as ecart_median_entre_instantanes_s,
  {seconds("gl.v[len(gl.v)] * cast(10000 as hugeint)", 1)} as ecart_max_entre_instantanes_s,
  gl.big as intervalles_superieurs_90s,
  {seconds(rank_value("al.v", 0.5), 2)} as age_du_flux_a_la_lecture_median_s,
  {seconds("al.v[len(al.v)] * cast(10000 as hugeint)", 2)} as age_du_flux_a_la_lecture_max_s,
  f.e as part_releves_vide, f.p as part_releves_pleine, f.r as taux_remplissage_moyen,
  (select cast(sum(capacite) as bigint) from dim) as capacite_totale, f.over_ as releves_velos_superieurs_capacite
from f, gl, al"""
    return q


def sql() -> dict[str, str]:
    return {**batch_sql(), **streamed_sql()}
