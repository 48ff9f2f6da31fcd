"""Catalogue entries for cleaning, audit and profiling."""

from __future__ import annotations

from ..functions import size_to_double, size_to_long, strip_brackets
from ..operators import audit, profile
from ..operators.sample import exact_sample, unit_sql
from ..sources.fixtures import MEM_SQL, PROC_DIRTY_SQL, PROC_SQL, mem, proc, proc_dirty
from .registry import DIGITS, register, with_views

PROC = with_views(PROC_SQL)
MEM = with_views(MEM_SQL)
DIRTY = with_views(PROC_DIRTY_SQL)


@register("proc_view", PROC + "SELECT * FROM proc")
def q_proc_view(spark, sf):
    """The process-like view itself (S1 stand-in, P3)."""
    return proc(spark, sf)


@register("size_to_number", MEM + """
SELECT pid, seq, rsize,
       try_cast(replace(replace(replace(replace(rsize,'K','000'),'M','000000'),'G','000000000'),' ','') AS DOUBLE) AS rsize_num,
       try_cast(replace(replace(replace(replace(vsize,'K','000'),'M','000000'),'G','000000000'),' ','') AS BIGINT) AS vsize_num,
       try_cast(replace(replace(replace(replace(minflt,'K','000'),'M','000000'),'G','000000000'),' ','') AS BIGINT) AS minflt_num
FROM mem""")
def q_size_to_number(spark, sf):
    """Unit text to numbers (F1, F2, P1) over every line item."""
    m = mem(spark, sf)
    return m.select("pid", "seq", "rsize",
                    size_to_double("rsize").alias("rsize_num"),
                    size_to_long("vsize").alias("vsize_num"),
                    size_to_long("minflt").alias("minflt_num"))


@register("strip_brackets", MEM + "SELECT pid, seq, cmd, rtrim(ltrim(cmd, '<'), '>') AS cmd_clean FROM mem")
def q_strip_brackets(spark, sf):
    """Bracket removal."""
    return mem(spark, sf).select("pid", "seq", "cmd", strip_brackets("cmd").alias("cmd_clean"))


@register("missing_audit", DIRTY + """
SELECT count_if(sequence IS NULL) AS sequence,
       count_if(cpu IS NULL OR isnan(cpu)) AS cpu,
       count_if(cmd IS NULL OR coalesce(isnan(try_cast(cmd AS DOUBLE)), false)) AS cmd
FROM proc_dirty""")
def q_missing_audit(spark, sf):
    """Null/NaN count per column in one pass."""
    return audit.missing_counts(proc_dirty(spark, sf))


@register("class_counts", PROC + "SELECT attack, count(attack) AS Total FROM proc GROUP BY attack")
def q_class_counts(spark, sf):
    """Rows per class (A3, O3)."""
    return profile.class_counts(proc(spark, sf), "attack", "Total")


@register("attacks_by_type", PROC + """
SELECT type, CAST(sum(attack) AS BIGINT) AS total_attacks FROM proc GROUP BY type""")
def q_attacks_by_type(spark, sf):
    """Attacks per attack type, descending (A5, O2, V1) — the flagship query."""
    return profile.sum_by(proc(spark, sf), "type", "attack", "total_attacks")


@register("top_commands", PROC + """
SELECT cmd, count(cmd) AS Total FROM (SELECT rtrim(ltrim(cmd, '<'), '>') AS cmd FROM proc)
GROUP BY cmd ORDER BY Total DESC, cmd NULLS FIRST LIMIT 10""")
def q_top_commands(spark, sf):
    """Top 10 cleaned commands by frequency (A4, O1)."""
    p = proc(spark, sf).select(strip_brackets("cmd").alias("cmd"))
    return profile.top_values(p, "cmd", 10, "Total")


@register("top_states", PROC + """
SELECT state, count(state) AS Total FROM proc GROUP BY state
ORDER BY Total DESC, state NULLS FIRST LIMIT 10""")
def q_top_states(spark, sf):
    """Top values of another categorical column (A4, O1)."""
    return profile.top_values(proc(spark, sf), "state", 10, "Total")


@register("top_values_all", PROC + """
SELECT column_name AS "column", value, n, rank FROM (
  SELECT column_name, value, n,
         row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rank
  FROM (SELECT column_name, value, count(*) AS n FROM (
          SELECT 'cmd' AS column_name, rtrim(ltrim(cmd, '<'), '>') AS value FROM proc
          UNION ALL SELECT 'state', state FROM proc
          UNION ALL SELECT 'type', type FROM proc
          UNION ALL SELECT 'tslpi', CAST(tslpi AS VARCHAR) FROM proc)
        WHERE value IS NOT NULL GROUP BY column_name, value))
WHERE rank <= 10""")
def q_top_values_all(spark, sf):
    """Top 10 values of four columns in a single pass (A4, O1)."""
    p = proc(spark, sf).withColumn("cmd", strip_brackets("cmd"))
    return profile.top_values_many(p, ["cmd", "state", "type", "tslpi"], 10)


_PROFILE_COLS = ["cpu", "tslpi", "ts"]


def _profile_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM proc"
             for c in _PROFILE_COLS]
    r = lambda e: f"round({e}, {DIGITS})"
    return PROC + ", long AS (" + " UNION ALL ".join(parts) + ")\n" + f"""
SELECT column_name, count(value) AS count, {r('avg(value)')} AS mean,
       {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min,
       {r('quantile_cont(value, 0.25)')} AS p25, {r('quantile_cont(value, 0.5)')} AS p50,
       {r('quantile_cont(value, 0.75)')} AS p75, {r('max(value)')} AS max
FROM long WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column_name"""


@register("numeric_profile", _profile_sql())
def q_numeric_profile(spark, sf):
    """count/mean/std/min/quartiles/max per numeric column."""
    out = profile.numeric_profile(proc(spark, sf), _PROFILE_COLS, digits=DIGITS, method="exact")
    return out.withColumnRenamed("column", "column_name")


_CORR_COLS = ["cpu", "tslpi", "ts", "attack"]


def _corr_sql() -> str:
    rows = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            for x, y in ((a, b), (b, a)):
                rows.append(f"SELECT '{x}' AS x, '{y}' AS y, round(corr(CAST({a} AS DOUBLE), "
                            f"CAST({b} AS DOUBLE)), {DIGITS}) + 0.0 AS r FROM proc")
    for c in _CORR_COLS:
        rows.append(f"SELECT '{c}' AS x, '{c}' AS y, CAST(1.0 AS DOUBLE) AS r")
    return PROC + "\n UNION ALL ".join(rows)


@register("correlation_pairs", _corr_sql())
def q_correlation_pairs(spark, sf):
    """Pearson correlation matrix in long form."""
    return profile.correlation_pairs(proc(spark, sf), _CORR_COLS, digits=DIGITS)


@register("row_count", PROC + "SELECT count(*) AS n FROM proc")
def q_row_count(spark, sf):
    """Total rows (A1)."""
    return profile.row_count(proc(spark, sf))


@register("machine_list", PROC + "SELECT DISTINCT machine FROM proc")
def q_machine_list(spark, sf):
    """Distinct machines."""
    return proc(spark, sf).select("machine").distinct()


@register("grid_density", PROC + """
SELECT CAST(floor(cpu / 25) AS BIGINT) AS x_bin, CAST(floor(tslpi / 10) AS BIGINT) AS y_bin,
       attack, count(*) AS n
FROM proc GROUP BY 1, 2, 3""")
def q_grid_density(spark, sf):
    """Scatter data as grid counts per class (V2, V3)."""
    return profile.grid_density(proc(spark, sf), "cpu", "tslpi", 25.0, 10.0, "attack")


@register("peak_per_machine", PROC + """
SELECT machine, max(cpu) AS max_cpu, arg_max(sequence, (cpu, -sequence)) AS argmax_sequence,
       min(cpu) AS min_cpu, arg_min(sequence, (cpu, sequence)) AS argmin_sequence
FROM proc GROUP BY machine""")
def q_peak_per_machine(spark, sf):
    """Arg-max / arg-min with first-occurrence ties, per machine."""
    return profile.arg_extremes(proc(spark, sf), "sequence", "cpu", "sequence", ["machine"])


# --- memory-like table: the reference's cleaning, then the audit again -------

_ZERO = "replace(replace(replace(replace({c},'K','000'),'M','000000'),'G','000000000'),' ','')"
MEM_CLEAN_SQL = f"""mem_clean AS (
  SELECT pid, seq,
         try_cast({_ZERO.format(c='rsize')} AS DOUBLE) AS rsize,
         try_cast({_ZERO.format(c='vsize')} AS DOUBLE) AS vsize,
         try_cast({_ZERO.format(c='minflt')} AS BIGINT) AS minflt,
         rtrim(ltrim(cmd, '<'), '>') AS cmd, attack
  FROM mem)"""


def _mem_clean(spark, sf):
    from ..operators.clean import clean_command, clean_sizes
    return clean_command(clean_sizes(mem(spark, sf), ["rsize", "vsize"], ["minflt"]), "cmd")


@register("mem_clean", with_views(MEM_SQL, MEM_CLEAN_SQL) + "SELECT * FROM mem_clean")
def q_mem_clean(spark, sf):
    """Sizes replaced by numbers and commands unbracketed in one projection."""
    return _mem_clean(spark, sf)


@register("missing_audit_mem", with_views(MEM_SQL, MEM_CLEAN_SQL) + """
SELECT count_if(pid IS NULL) AS pid, count_if(seq IS NULL) AS seq,
       count_if(rsize IS NULL OR isnan(rsize)) AS rsize, count_if(vsize IS NULL OR isnan(vsize)) AS vsize,
       count_if(minflt IS NULL) AS minflt,
       count_if(cmd IS NULL OR coalesce(isnan(try_cast(cmd AS DOUBLE)), false)) AS cmd,
       count_if(attack IS NULL) AS attack
FROM mem_clean""")
def q_missing_audit_mem(spark, sf):
    """Audit after cleaning: unparsable sizes show up as missing."""
    return audit.missing_counts(_mem_clean(spark, sf))


@register("missing_audit_mem_raw", with_views(MEM_SQL) + """
SELECT count_if(pid IS NULL) AS pid, count_if(seq IS NULL) AS seq,
       count_if(rsize IS NULL OR coalesce(isnan(try_cast(rsize AS DOUBLE)), false)) AS rsize,
       count_if(vsize IS NULL OR coalesce(isnan(try_cast(vsize AS DOUBLE)), false)) AS vsize,
       count_if(minflt IS NULL OR coalesce(isnan(try_cast(minflt AS DOUBLE)), false)) AS minflt,
       count_if(cmd IS NULL OR coalesce(isnan(try_cast(cmd AS DOUBLE)), false)) AS cmd,
       count_if(attack IS NULL) AS attack
FROM mem""")
def q_missing_audit_mem_raw(spark, sf):
    """Audit of the raw memory-like table, before cleaning (A2)."""
    return audit.missing_counts(mem(spark, sf))


_MEM_NUM = ["rsize", "vsize", "minflt"]


def _mem_profile_sql() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM mem_clean"
             for c in _MEM_NUM]
    r = lambda e: f"round({e}, {DIGITS})"
    return with_views(MEM_SQL, MEM_CLEAN_SQL) + ", long AS (" + " UNION ALL ".join(parts) + ")\n" + f"""
SELECT column_name, count(value) AS count, {r('avg(value)')} AS mean,
       {r('stddev_samp(value)')} AS std, {r('min(value)')} AS min,
       {r('quantile_cont(value, 0.25)')} AS p25, {r('quantile_cont(value, 0.5)')} AS p50,
       {r('quantile_cont(value, 0.75)')} AS p75, {r('max(value)')} AS max
FROM long WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY column_name"""


@register("numeric_profile_mem", _mem_profile_sql())
def q_numeric_profile_mem(spark, sf):
    """Profile of the cleaned memory-like sizes, heavy-tailed by their K/M/G
    suffixes (A15, F5)."""
    out = profile.numeric_profile(_mem_clean(spark, sf), _MEM_NUM, digits=DIGITS, method="exact")
    return out.withColumnRenamed("column", "column_name")


def _mem_corr_sql() -> str:
    cols = _MEM_NUM + ["attack"]
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            for x, y in ((a, b), (b, a)):
                rows.append(f"SELECT '{x}' AS x, '{y}' AS y, round(corr(CAST({a} AS DOUBLE), "
                            f"CAST({b} AS DOUBLE)), {DIGITS}) + 0.0 AS r FROM mem_clean")
    for c in cols:
        rows.append(f"SELECT '{c}' AS x, '{c}' AS y, CAST(1.0 AS DOUBLE) AS r")
    return with_views(MEM_SQL, MEM_CLEAN_SQL) + "\n UNION ALL ".join(rows)


@register("correlation_pairs_mem", _mem_corr_sql())
def q_correlation_pairs_mem(spark, sf):
    """Correlation matrix of the cleaned memory-like table, as the reference's
    heat map (A16, V4)."""
    return profile.correlation_pairs(_mem_clean(spark, sf), _MEM_NUM + ["attack"], digits=DIGITS)


@register("grid_density_mem", with_views(MEM_SQL, MEM_CLEAN_SQL) + """
SELECT CAST(floor(log10(1.0 + vsize) / 1.0) AS BIGINT) AS x_bin,
       CAST(floor(log10(1.0 + rsize) / 1.0) AS BIGINT) AS y_bin, attack, count(*) AS n
FROM mem_clean GROUP BY 1, 2, 3""")
def q_grid_density_mem(spark, sf):
    """Memory scatter data (sizes against sizes) as decade-grid counts per class (V3)."""
    return profile.grid_density(_mem_clean(spark, sf), "vsize", "rsize", 1.0, 1.0, "attack",
                                log_scale=True)


# --- columns of many values, samples of a fixed size ---------------------------

@register("top_pids", PROC + """
SELECT pid, count(*) AS "Total" FROM proc WHERE pid IS NOT NULL GROUP BY pid ORDER BY 2 DESC, 1 LIMIT 25""")
def q_top_pids(spark, sf):
    """The 25 most frequent process ids, by cell counts and an exact second pass (A4, O1)."""
    return profile.heavy_hitters(proc(spark, sf), "pid", 25, "Total")


@register("top_faults", with_views(MEM_SQL) + """
SELECT minflt, count(*) AS "Total" FROM mem WHERE minflt IS NOT NULL GROUP BY minflt ORDER BY 2 DESC, 1 LIMIT 10""")
def q_top_faults(spark, sf):
    """The same for a column whose values are nearly all different."""
    return profile.heavy_hitters(mem(spark, sf), "minflt", 10, "Total")


SAMPLE_SIZE = 200


def _exact_sql(view: str, name: str, cols: str, key: str) -> str:
    return view + f"""
SELECT {cols} FROM {name}
QUALIFY row_number() OVER (PARTITION BY attack ORDER BY {unit_sql(key, purpose='sample')}, {key}) <= {SAMPLE_SIZE}"""


@register("exact_sample", _exact_sql(PROC, "proc", "sequence, attack, cpu, tslpi", "sequence"))
def q_exact_sample(spark, sf):
    """Exactly 200 rows of each class, by hashed priority (M2)."""
    p = proc(spark, sf).select("sequence", "attack", "cpu", "tslpi")
    return exact_sample(p, SAMPLE_SIZE, "sequence", "attack")


@register("scatter_points", _exact_sql(PROC, "proc", "cpu, tslpi, attack", "sequence"))
def q_scatter_points(spark, sf):
    """Points of a scatter plot, the same number of each class (V2, V3)."""
    return profile.scatter_sample(proc(spark, sf), ["cpu", "tslpi"], "attack", size=SAMPLE_SIZE, key="sequence")
