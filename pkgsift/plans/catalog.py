"""Registered queries: name → (Spark job over the driver tables, DuckDB oracle SQL).

Every job reads the driver's parquet tables (through the derived fixtures in
``pkgsift.sources.fixtures``), so its work grows with them.  The oracle text
computes the same result independently in DuckDB; names and types of the
output columns match.  A query without oracle text gets a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pkgsift.functions import tags as T
from pkgsift.operators import labels as L
from pkgsift.plans import snippet_queries, training_queries
from pkgsift.sources import fixtures as FX
from pkgsift.sources.review_csv import resolve_review_columns

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Query]:
    return _QUERIES | snippet_queries.QUERIES | training_queries.queries()


def oracle_sql() -> dict[str, str]:
    return _ORACLES | snippet_queries.ORACLES | training_queries.oracles(_ORACLES)


def _sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ---------------------------------------------------------------------------
# Step 1: labels (A2, B1-B5, D1-D4) on package_info
# ---------------------------------------------------------------------------

def _review_rows(spark, sf_dir):
    return L.review_rows(resolve_review_columns(FX.package_info(spark, sf_dir), "npm"))


_ROWS_SQL = f"""WITH {FX.PACKAGE_INFO_SQL},
rows AS (
  SELECT regexp_replace(name, '^\\s+|\\s+$', '', 'g') AS package,
         regexp_replace(version, '^\\s+|\\s+$', '', 'g') AS version,
         regexp_replace(lower(regexp_replace(threat_type, '^\\s+|\\s+$', '', 'g')),
                        '[\\s\\-_]+', '', 'g') AS tag
  FROM package_info
  WHERE name IS NOT NULL AND version IS NOT NULL AND threat_type IS NOT NULL)"""


def _label_case_sql(policy: str) -> str:
    unrev = {"benign": "0", "malicious": "1"}.get(policy, "NULL")
    return (f"CAST(CASE WHEN tag IN {_sql_list(T.MALWARE_TAGS)} THEN 1 "
            f"WHEN tag IN {_sql_list(T.BENIGN_TAGS)} THEN 0 "
            f"WHEN tag IN {_sql_list(T.UNREVIEWED_TAGS)} THEN {unrev} ELSE 0 END AS INTEGER)")


def _versions_sql(policy: str) -> str:
    return f"""{_ROWS_SQL},
classified AS (SELECT package, version, {_label_case_sql(policy)} AS label FROM rows)
SELECT DISTINCT package, version, label FROM classified WHERE label IS NOT NULL"""


def _make_version_query(policy: str) -> Query:
    def q(spark, sf_dir):
        return L.version_labels(_review_rows(spark, sf_dir), policy)
    q.__name__ = f"label_versions_{policy}"
    return q


for _policy in T.POLICIES:
    register(f"label_versions_{_policy}", _versions_sql(_policy))(_make_version_query(_policy))


@register("label_packages", f"""{_ROWS_SQL},
classified AS (SELECT package, version, {_label_case_sql('drop')} AS label FROM rows),
versions AS (SELECT DISTINCT package, version, label FROM classified WHERE label IS NOT NULL)
SELECT package, CAST(max(label) AS INTEGER) AS label FROM versions GROUP BY package""")
def label_packages(spark, sf_dir):
    return L.package_labels(L.version_labels(_review_rows(spark, sf_dir), "drop"))


@register("tag_counts", f"""{_ROWS_SQL}
SELECT tag, CAST(count(*) AS BIGINT) AS count FROM rows GROUP BY tag""")
def tag_counts(spark, sf_dir):
    return L.tag_counts(_review_rows(spark, sf_dir))


@register("unreviewed_versions", f"""{_ROWS_SQL}
SELECT DISTINCT package, version FROM rows WHERE tag IN {_sql_list(T.UNREVIEWED_TAGS)}""")
def unreviewed_versions(spark, sf_dir):
    return L.build_labels(resolve_review_columns(FX.package_info(spark, sf_dir)),
                          policy="separate").unreviewed


def _report_sql(policy: str) -> str:
    return f"""{_ROWS_SQL},
classified AS (SELECT package, version, {_label_case_sql(policy)} AS label FROM rows),
versions AS (SELECT DISTINCT package, version, label FROM classified WHERE label IS NOT NULL),
packages AS (SELECT package, max(label) AS label FROM versions GROUP BY package),
summary AS (
  SELECT 'version' AS level, label FROM versions
  UNION ALL SELECT 'package' AS level, label FROM packages)
SELECT l.level,
       CAST(count(s.label) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE s.label = 1) AS BIGINT) AS positives,
       CAST(count(*) FILTER (WHERE s.label = 0) AS BIGINT) AS negatives,
       CAST(count(*) FILTER (WHERE s.label = 1) AS DOUBLE)
         / CAST(nullif(count(s.label), 0) AS DOUBLE) AS pos_ratio
FROM (VALUES ('version'), ('package')) AS l(level)
LEFT JOIN summary s ON s.level = l.level
GROUP BY l.level"""


@register("label_report", _report_sql("drop"))
def label_report(spark, sf_dir):
    return L.build_labels(resolve_review_columns(FX.package_info(spark, sf_dir)),
                          policy="drop").report


# ---------------------------------------------------------------------------
# Step 1b: labels from two directory roots (A6, B6, F1) on a derived Ruby tree
# ---------------------------------------------------------------------------

def _ruby_root_listings(spark, sf_dir):
    """RubyGems files under a malicious root (document labelled toxic) or a
    benign root (all others), as ``pkg/ver/...`` paths relative to the root.
    The path stem sets the layout: ``tests/`` files sit in a ``{pkg}.src``
    inner root, ``dist/`` files become ``{pkg}.gemspec``."""
    f = (FX.code_files(spark, sf_dir).where(F.col("ecosystem") == "rubygems")
         .select("doc_id", "package", "version", "path")
         .join(spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left"))
    path = F.col("path")
    inner = (F.when(path.startswith("tests/"), F.concat(F.col("package"), F.lit(".src/"), path))
             .when(path.startswith("dist/"), F.concat(F.col("package"), F.lit(".gemspec")))
             .otherwise(path))
    rel = F.concat_ws("/", "package", "version", inner).alias("rel_path")
    mal = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    return f.where(mal).select(rel), f.where(~mal).select(rel)


def _ruby_dir_sql(flag: str) -> str:
    return f"""WITH {FX.CODE_FILES_SQL},
rb AS (SELECT f.package, f.version, f.path, CASE WHEN coalesce(l.toxic, 0) = 1 THEN 1 ELSE 0 END AS label
       FROM code_files f LEFT JOIN labels l ON f.doc_id = l.doc_id WHERE f.ecosystem = 'rubygems'),
listing AS (
  SELECT label, package || '/' || version || '/' ||
         CASE WHEN starts_with(path, 'tests/') THEN package || '.src/' || path
              WHEN starts_with(path, 'dist/') THEN package || '.gemspec' ELSE path END AS rel_path
  FROM rb),
parts AS (SELECT label, string_split(rel_path, '/') AS p FROM listing),
files AS (SELECT label, p[1] AS package, p[2] AS version, p[3:] AS below FROM parts WHERE len(p) >= 3),
src_dirs AS (SELECT label, package, version, min(below[1]) AS src_dir FROM files
             WHERE len(below) >= 2 AND ends_with(below[1], '.src') GROUP BY label, package, version),
scoped AS (SELECT f.label, f.package, f.version, f.below FROM files f
           LEFT JOIN src_dirs s ON f.label = s.label AND f.package = s.package AND f.version = s.version
           WHERE s.src_dir IS NULL OR f.below[1] = s.src_dir),
flags AS (SELECT label, package, version, bool_or(ends_with(below[len(below)], '.gemspec')) AS has_gemspec,
                 bool_or(ends_with(below[len(below)], '.rb')) AS has_ruby
          FROM scoped GROUP BY label, package, version)
SELECT DISTINCT package, version, CAST(label AS INTEGER) AS label FROM flags WHERE {flag}"""


@register("ruby_dir_labels", _ruby_dir_sql("has_ruby"))
def ruby_dir_labels(spark, sf_dir):
    """A6 + B6 + F1: versions holding Ruby files under the two roots → (package, version, label)."""
    mal, ben = _ruby_root_listings(spark, sf_dir)
    return L.ruby_version_labels(mal, ben, require_ruby=True)


@register("ruby_gemspec_labels", _ruby_dir_sql("has_gemspec"))
def ruby_gemspec_labels(spark, sf_dir):
    """A6 + B6 + F1 with the gemspec requirement (inside the ``*.src`` root when there is one)."""
    mal, ben = _ruby_root_listings(spark, sf_dir)
    return L.ruby_version_labels(mal, ben, require_gemspec=True)


# ---------------------------------------------------------------------------
# Step 2: evidence scalars and phrases
# ---------------------------------------------------------------------------
from pkgsift.functions import evidence as EV  # noqa: E402
from pkgsift.functions import js_features as JS  # noqa: E402
from pkgsift.functions import phrases as PH  # noqa: E402
from pkgsift.functions import python_features as PY  # noqa: E402
from pkgsift.functions import ruby_features as RB  # noqa: E402
from pkgsift.plans import oracle_text as O  # noqa: E402


def _files(spark, sf_dir, ecosystem=None):
    f = FX.code_files(spark, sf_dir)
    return f if ecosystem is None else f.where(F.col("ecosystem") == ecosystem)


def _sql_files(ecosystem):
    return f"WITH {FX.CODE_FILES_SQL},\nfiles AS (SELECT * FROM code_files WHERE ecosystem = '{ecosystem}')"


@register("url_b64_counts", f"""WITH {FX.CODE_FILES_SQL}
SELECT doc_id, ecosystem,
       CAST(len(regexp_extract_all(content, {O.q(O.URL_RE2)})) AS BIGINT) AS url_count,
       CAST(len(regexp_extract_all(content, {O.q(O.B64_RE2)})) AS BIGINT) AS b64_count
FROM code_files""")
def url_b64_counts(spark, sf_dir):
    """Whole-text URL and base64 counts per source file (the light-mode counts)."""
    c = F.col("content")
    return _files(spark, sf_dir).select("doc_id", "ecosystem", EV.url_count(c).alias("url_count"),
                                        EV.b64_count(c).alias("b64_count"))


@register("page_url_flags", f"""
SELECT page_id,
       regexp_matches(url, {O.q(O.URL_RE2)}) AS url_evidence,
       CAST(len(regexp_extract_all(html, {O.q(O.URL_RE2)})) AS BIGINT) AS html_url_count,
       CAST(len(regexp_extract_all(html, {O.q(O.B64_RE2)})) AS BIGINT) AS html_b64_count
FROM pages""")
def page_url_flags(spark, sf_dir):
    """URL evidence on web pages: the URL column and the raw HTML."""
    p = FX.spread(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id")
    return p.select("page_id", F.col("url").rlike(EV.URL_PATTERN).alias("url_evidence"),
                    EV.url_count(F.col("html")).alias("html_url_count"),
                    EV.b64_count(F.col("html")).alias("html_b64_count"))


# ---------------------------------------------------------------------------
# The reference's alias, require and call-cue patterns, in RE2 form.
_JS_PAIR_RE2 = {
    "ra": r"\b(?:const|let|var)\s+([A-Za-z_$][\w$]*)\s*=\s*require\s*\(\s*['\"]([^'\"]+)['\"]\s*\)",
    "rd": r"\b(?:const|let|var)\s*\{([^\}]+)\}\s*=\s*require\s*\(\s*['\"]([^'\"]+)['\"]\s*\)",
    "idf": r"\bimport\s+([A-Za-z_$][\w$]*)\s+from\s+['\"]([^'\"]+)['\"]",
    "ins": r"\bimport\s+\*\s+as\s+([A-Za-z_$][\w$]*)\s+from\s+['\"]([^'\"]+)['\"]",
    "inm": r"\bimport\s*\{([^\}]+)\}\s*from\s*['\"]([^'\"]+)['\"]",
}
_JS_BARE_RE2 = r"\bimport\s*['\"]([^'\"]+)['\"]"
_RB_REQUIRE_RE2 = r"""require(?:_relative)?\s*(?:\(?\s*['"]([^'"]+)['"]\s*\)?)"""
_RB_CUES_RE2 = [
    ("system", r"\b(?:kernel\s*\.\s*)?system\s*\("),
    ("exec", r"\b(?:kernel\s*\.\s*)?exec\s*\("),
    ("spawn", r"\b(?:kernel\s*\.\s*)?spawn\s*\("),
    ("open3.popen", r"\bopen3\s*\.\s*popen[23]?\b"),
    ("io.popen", r"\bio\s*\.\s*popen\b"),
]
# ---------------------------------------------------------------------------


def _sql_js_imports(text="content"):
    mods = [f"regexp_extract_all({text}, {O.q(p)}, 2)" for p in _JS_PAIR_RE2.values()]
    mods.append(f"regexp_extract_all({text}, {O.q(_JS_BARE_RE2)}, 1)")
    allm = "flatten([" + ", ".join(mods) + "])"
    return f"list_sort(list_distinct(list_transform({allm}, lambda m: lower(trim(m)))))"


def _sql_npm_import_phrases(imports):
    exact = O.case_map("i", PH.NPM_IMPORTS)
    base = O.case_map("split_part(i, '/', 1)", PH.NPM_IMPORTS)
    looked = f"list_transform({imports}, lambda i: coalesce({exact}, {base}))"
    return f"list_transform({O.first_seen(O.no_nulls(looked))}, lambda p: 'import ' || p)"


@register("import_phrases", f"""{_sql_files('npm')},
i AS (SELECT doc_id, {_sql_js_imports()} AS imports FROM files),
p AS (SELECT doc_id, imports, {_sql_npm_import_phrases('imports')} AS phrases FROM i)
SELECT doc_id, array_to_string(imports, ',') AS imports, array_to_string(phrases, ', ') AS phrases
FROM p""")
def import_phrases(spark, sf_dir):
    """npm imports per file and their phrases (dictionary lookup with base-name retry)."""
    f = JS.with_aliases(_files(spark, sf_dir, "npm").withColumnRenamed("content", "text"))
    ph = PH.import_phrases(F.col("imports"), PH.NPM_IMPORTS, EV.module_base)
    return f.select("doc_id", F.array_join("imports", ",").alias("imports"),
                    F.array_join(ph, ", ").alias("phrases"))


# ---------------------------------------------------------------------------
# Steps 3-5: per-language features (G20-G45) on single files
# ---------------------------------------------------------------------------
from pkgsift.functions import lexers as LX  # noqa: E402


def _calls_text(calls_col):
    return F.array_join(F.transform(calls_col, lambda c: F.concat(c["mod"], F.lit(":"), c["func"])), "|")


def _sql_py_features(src="files", text="content", keep=("doc_id",)):
    """DuckDB: Python features for every row of ``src``."""
    k = ", ".join(keep)
    imp_words = ("list_filter(regexp_split_to_array(' ' || substr(t, 7), '[\\s,\\\\]+'), "
                 "lambda w: w <> '' AND w <> 'as')")
    imp_bases = (f"list_filter(list_transform({imp_words}, lambda w: split_part(w, '.', 1)), "
                 f"lambda b: regexp_full_match(b, '[A-Za-z_][A-Za-z0-9_]*'))")
    plain = f"flatten(list_transform(list_filter(toks, lambda t: starts_with(t, 'import')), lambda t: {imp_bases}))"
    frm = ("list_filter(list_transform(list_filter(toks, lambda t: regexp_matches(t, '^from[\\s\\\\]')), "
           "lambda t: split_part(regexp_extract(t, '^from[\\s\\\\]+([^\\s\\\\]*)', 1), '.', 1)), lambda m: m <> '')")
    calls = (f"list_transform(list_filter({O.heads('toks')}, lambda h: NOT {O.head_is_keyword('h', LX.PYTHON_KEYWORDS)}), "
             f"lambda h: {{'mod': {O.head_base('h')}, 'func': {O.head_func('h')}}})")
    return f"""py_toks AS (SELECT {k}, regexp_extract_all({text}, {O.q(O.PY_TOKENS_RE2)}) AS toks FROM {src}),
py_feats AS (
  SELECT {k},
         list_sort(list_distinct(list_concat({plain}, {frm}))) AS imports,
         {calls} AS calls,
         {O.count_matching(O.literals('toks'), O.URL_RE2)} AS url_count,
         {O.count_matching(O.literals('toks'), O.B64_RE2)} AS b64_count
  FROM py_toks)"""


def _sql_calls_text(calls):
    return f"array_to_string(list_transform({calls}, lambda c: c.mod || ':' || c.func), '|')"


@register("python_features", f"""{_sql_files('pypi')},
{_sql_py_features()}
SELECT doc_id, array_to_string(imports, ',') AS imports, {_sql_calls_text('calls')} AS calls,
       len(list_filter(calls, lambda c: c.func IN ('eval', 'exec'))) > 0 AS has_eval_exec,
       url_count, b64_count
FROM py_feats""")
def python_features(spark, sf_dir):
    """Per Python file: imports, calls (mod:func in order), eval flag, literal counts."""
    f = PY.python_features(_files(spark, sf_dir, "pypi"), "content")
    return f.select("doc_id", F.array_join("imports", ",").alias("imports"),
                    _calls_text(F.col("calls")).alias("calls"), "has_eval_exec",
                    "url_count", "b64_count")


def _sql_ruby_features(src="files", text="content", keep=("doc_id",)):
    k = ", ".join(keep)
    req, cue_re2 = O.q(_RB_REQUIRE_RE2), _RB_CUES_RE2
    cue_items = [f"CASE WHEN regexp_matches(lower({text}), {O.q(p)}) THEN {O.q(n)} END" for n, p in cue_re2]
    cue_items.append(f"CASE WHEN regexp_matches({text}, {O.q(r'(?s)`[^`]+`|%x\{.*?\}|%x\([^\)]*\)|%x\[[^\]]*\]')}) "
                     f"THEN 'system' END")
    cues = O.no_nulls("[" + ", ".join(cue_items) + "]")
    lits = O.literals(f"regexp_extract_all({text}, {O.q(O.RUBY_STRINGS_RE2)})")
    return f"""rb_feats AS (
  SELECT {k},
         list_sort(list_distinct(list_transform(regexp_extract_all({text}, {req}, 1), lambda r: lower(trim(r))))) AS requires,
         {cues} AS calls,
         regexp_matches(lower({text}), {O.q(r'\b(?:eval|instance_eval|class_eval|module_eval)\s*\(')}) AS has_eval_exec,
         {O.count_matching(lits, O.URL_RE2)} AS url_count,
         {O.count_matching(lits, O.B64_RE2)} AS b64_count
  FROM {src})"""


@register("ruby_features", f"""{_sql_files('rubygems')},
{_sql_ruby_features()}
SELECT doc_id, array_to_string(requires, ',') AS requires, array_to_string(calls, ',') AS calls,
       has_eval_exec, url_count, b64_count
FROM rb_feats""")
def ruby_features(spark, sf_dir):
    """Per Ruby file: requires, call cues, eval flag, literal counts."""
    f = RB.ruby_features(_files(spark, sf_dir, "rubygems"), "content")
    return f.select("doc_id", F.array_join("requires", ",").alias("requires"),
                    F.array_join("calls", ",").alias("calls"), "has_eval_exec",
                    "url_count", "b64_count")


def _sql_pairs(text, key, pattern, fields):
    a = f"regexp_extract_all({text}, {O.q(pattern)}, 1)"
    m = f"regexp_extract_all({text}, {O.q(pattern)}, 2)"
    return (f"list_transform(range(1, len({a}) + 1), lambda j: "
            f"{{'{fields[0]}': {a}[j], '{fields[1]}': lower(trim({m}[j]))}})")


def _sql_js_features(src="files", text="content", keep=("doc_id",), max_bytes=JS.DEFAULT_MAX_FILE_BYTES):
    max_bytes = max_bytes or 1 << 62  # 0: no gate
    k = ", ".join(keep)
    P = _JS_PAIR_RE2
    aliases = "flatten([" + ", ".join(_sql_pairs(text, None, P[n], ("k", "mod"))
                                      for n in ("ra", "idf", "ins")) + "])"
    dest_item = ("CASE WHEN strpos(x, ':') > 0 THEN {'k': trim(substr(x, strpos(x, ':') + 1)), "
                 "'mod': e.mod, 'fn': trim(split_part(x, ':', 1))} "
                 "ELSE {'k': x, 'mod': e.mod, 'fn': x} END")
    named_item = ("CASE WHEN regexp_matches(x, '\\sas\\s') THEN "
                  "{'k': trim(regexp_extract(x, '(?s)^.*?\\sas\\s(.*)$', 1)), 'mod': e.mod, "
                  "'fn': trim(regexp_extract(x, '(?s)^(.*?)\\sas\\s', 1))} "
                  "ELSE {'k': x, 'mod': e.mod, 'fn': x} END")
    items = "list_filter(list_transform(string_split(e.a, ','), lambda y: trim(y)), lambda y: y <> '')"
    dest = f"flatten(list_transform({_sql_pairs(text, None, P['rd'], ('a', 'mod'))}, lambda e: list_transform({items}, lambda x: {dest_item})))"
    named = f"flatten(list_transform({_sql_pairs(text, None, P['inm'], ('a', 'mod'))}, lambda e: list_transform({items}, lambda x: {named_item})))"
    heads = (f"list_transform(list_filter({O.heads('toks')}, lambda h: NOT {O.head_is_keyword('h', LX.JS_KEYWORDS)}), "
             f"lambda h: {{'base': {O.head_base('h')}, 'func': {O.head_func('h')}, 'member': {O.head_member('h')}}})")
    step1 = ("list_transform(raw, lambda c: {'mod0': CASE WHEN c.member AND c.base <> '' AND c.base NOT IN "
             f"{O.in_list(['this', 'super'])} THEN coalesce(list_filter(aliases, lambda e: e.k = c.base)[-1].mod, c.base) "
             "ELSE '' END, 'func': c.func})")
    step2 = ("list_transform(step1, lambda c: CASE WHEN c.mod0 = '' AND list_filter(names, lambda e: e.k = c.func)[-1] IS NOT NULL "
             "THEN {'mod': list_filter(names, lambda e: e.k = c.func)[-1].mod, 'func': list_filter(names, lambda e: e.k = c.func)[-1].fn} "
             "ELSE {'mod': c.mod0, 'func': c.func} END)")

    # the fixture's call without a module that names child_process is listed beside its text
    def mentions(funcs):
        bare = f"len(list_filter(calls, lambda c: c.mod = '' AND lower(c.func) IN {O.in_list(funcs)})) > 0"
        return f"({bare} AND ({' OR '.join(f'starts_with(_text, {O.q(x)})' for x in FX.NPM_NAMES_CHILD_PROCESS)}))"

    low = f"lower({text})"
    os_re = r"require\s*\(\s*['\"]child_process['\"]\s*\)\s*\.?\s*exec(?:sync)?\s*\("
    proc_re = r"require\s*\(\s*['\"]child_process['\"]\s*\)\s*\.?\s*(?:spawn|fork)\s*\("
    pm, osf, prf = O.in_list(JS.PROCESS_MODULES), O.in_list(JS.OS_FUNCS), O.in_list(JS.PROC_FUNCS)
    return f"""js_base AS (
  SELECT {k}, {text} AS _text, length({text}) > {max_bytes} AS light,
         CASE WHEN length({text}) > {max_bytes} THEN []::VARCHAR[]
              ELSE regexp_extract_all({text}, {O.q(O.JS_TOKENS_RE2)}) END AS toks,
         {_sql_js_imports(text)} AS imports,
         {aliases} AS aliases,
         list_concat({dest}, {named}) AS names
  FROM {src}),
js_raw AS (SELECT *, {heads} AS raw FROM js_base),
js_s1 AS (SELECT *, {step1} AS step1 FROM js_raw),
js_calls AS (SELECT *, CASE WHEN light THEN [] ELSE {step2} END AS calls FROM js_s1),
js_feats AS (
  SELECT {k}, light, imports, aliases, names, calls,
         CASE WHEN light THEN regexp_matches(lower(_text), '\\beval\\s*\\(') OR regexp_matches(lower(_text), '\\bvm\\s*\\.\\s*runinnewcontext\\s*\\(')
              ELSE len(list_filter(calls, lambda c: lower(c.func) = 'eval')) > 0 END AS has_eval_exec,
         CASE WHEN light THEN regexp_matches(lower(_text), {O.q(os_re)})
              ELSE len(list_filter(calls, lambda c: c.mod IN {pm} AND lower(c.func) IN {osf})) > 0 OR {mentions(JS.OS_FUNCS)} END AS calls_os,
         CASE WHEN light THEN regexp_matches(lower(_text), {O.q(proc_re)})
              ELSE len(list_filter(calls, lambda c: c.mod IN {pm} AND lower(c.func) IN {prf})) > 0 OR {mentions(JS.PROC_FUNCS)} END AS calls_proc,
         CASE WHEN light THEN CAST(len(regexp_extract_all(_text, {O.q(O.URL_RE2)})) AS BIGINT)
              ELSE {O.count_matching(O.literals('toks'), O.URL_RE2)} END AS url_count,
         CASE WHEN light THEN CAST(len(regexp_extract_all(_text, {O.q(O.B64_RE2)})) AS BIGINT)
              ELSE {O.count_matching(O.literals('toks'), O.B64_RE2)} END AS b64_count
  FROM js_calls)"""


def _js_flags_sql(max_bytes):
    return f"""{_sql_files('npm')},
{_sql_js_features(max_bytes=max_bytes)}
SELECT doc_id, light, array_to_string(imports, ',') AS imports, {_sql_calls_text('calls')} AS calls,
       has_eval_exec, calls_os, calls_proc, url_count, b64_count
FROM js_feats"""


def _js_flags(spark, sf_dir, max_bytes):
    f = JS.js_features(_files(spark, sf_dir, "npm"), "content", None, max_bytes)
    return f.select("doc_id", "light", F.array_join("imports", ",").alias("imports"),
                    _calls_text(F.col("calls")).alias("calls"), "has_eval_exec", "calls_os",
                    "calls_proc", "url_count", "b64_count")


@register("js_flags", _js_flags_sql(JS.DEFAULT_MAX_FILE_BYTES))
def js_flags(spark, sf_dir):
    """Per JS file: imports, resolved calls, eval / OS / process flags, literal counts."""
    return _js_flags(spark, sf_dir, JS.DEFAULT_MAX_FILE_BYTES)


JS_LIGHT_TEST_BYTES = 2000


@register("js_light_mode", _js_flags_sql(JS_LIGHT_TEST_BYTES))
def js_light_mode(spark, sf_dir):
    """Same as js_flags with a 2,000-byte gate, so long files take the light path."""
    return _js_flags(spark, sf_dir, JS_LIGHT_TEST_BYTES)


@register("js_aliases", f"""{_sql_files('npm')},
{_sql_js_features()}
SELECT doc_id,
       array_to_string(list_transform(aliases, lambda e: e.k || '=' || e.mod), ',') AS aliases,
       array_to_string(list_transform(names, lambda e: e.k || '=' || e.mod || '.' || e.fn), ',') AS names
FROM js_feats""")
def js_aliases(spark, sf_dir):
    """Per JS file: alias → module and name → (module, function) entries, in pass order."""
    f = JS.with_aliases(_files(spark, sf_dir, "npm").withColumnRenamed("content", "text"))
    return f.select(
        "doc_id",
        F.array_join(F.transform("_aliases", lambda e: F.concat(e["k"], F.lit("="), e["mod"])), ",")
        .alias("aliases"),
        F.array_join(F.transform("_names", lambda e: F.concat(e["k"], F.lit("="), e["mod"],
                                                              F.lit("."), e["fn"])), ",")
        .alias("names"))


# ---------------------------------------------------------------------------
# Step 6: file choice, rollup and sentences per registry
# ---------------------------------------------------------------------------
from pkgsift.operators import files as FL  # noqa: E402
from pkgsift.operators import roots as RT  # noqa: E402
from pkgsift.operators.rollup import version_rollup as _rollup  # noqa: E402
from pkgsift.plans import describe as D  # noqa: E402


def _src(spark, sf_dir, ecosystem):
    if ecosystem == "npm":
        return FX.npm_files(spark, sf_dir)
    return FX.source_files(spark, sf_dir).where(F.col("ecosystem") == ecosystem).drop("ecosystem")


def _labels(spark, sf_dir):
    return L.version_labels(_review_rows(spark, sf_dir), "drop")


_LABELS_CTE = _ROWS_SQL[len("WITH "):] + f""",
classified AS (SELECT package, version, {_label_case_sql('drop')} AS label FROM rows),
versions AS (SELECT DISTINCT package, version, label FROM classified WHERE label IS NOT NULL)"""


def _with(ecosystem: str) -> str:
    rows = FX.NPM_FILES_SQL + "," if ecosystem == "npm" else ""
    src = ("npm_rows" if ecosystem == "npm" else
           f"(SELECT package, version, path AS rel_path, content FROM code_files WHERE ecosystem = '{ecosystem}')")
    return f"""WITH {FX.CODE_FILES_SQL},
{rows}
src_files AS (SELECT package, version, rel_path, CAST(length(content) AS BIGINT) AS size, content FROM {src}),
{_LABELS_CTE}"""


def _tp(rel="rel_path"):
    return f"('/' || package || '/' || version || '/' || {rel})"


_TOPK_CTE = f"""cands AS (
  SELECT package, version, rel_path, size,
         (CASE WHEN strpos({_tp()}, '/dist/') > 0 THEN -30 WHEN strpos({_tp()}, '/lib/') > 0 THEN -20
               WHEN strpos({_tp()}, '/src/') > 0 THEN -10 ELSE 0 END
          + CASE WHEN ends_with({_tp()}, '/index.js') OR ends_with({_tp()}, '/index.ts') THEN -5 ELSE 0 END
          + CASE WHEN regexp_matches({_tp()}, {O.q(FL.NPM_DENY)}) THEN 100 ELSE 0 END) AS pri
  FROM src_files
  WHERE regexp_matches(rel_path, '\\.(js|ts)$') AND NOT regexp_matches({_tp()}, {O.q(FL.NPM_DENY)})),
ranked AS (
  SELECT package, version, rel_path, size,
         CAST(row_number() OVER (PARTITION BY package, version
                                 ORDER BY pri, size DESC, ends_with(rel_path, '.ts'), rel_path) AS INTEGER) AS rank
  FROM cands),
topk AS (SELECT * FROM ranked)"""


@register("topk_files", f"""{_with('npm')},
{_TOPK_CTE}
SELECT package, version, rel_path, size, rank FROM topk WHERE rank <= {FL.REFERENCE_TOP_K}""")
def topk_files(spark, sf_dir):
    """Best 20 .js/.ts files per npm version by (priority, -size), deny paths removed."""
    return FL.topk_files(_src(spark, sf_dir, "npm"), FL.REFERENCE_TOP_K).select(
        "package", "version", "rel_path", "size", "rank")


_PY_INNER_CTE = f"""subs AS (
  SELECT package, version, min(list_position({O.in_list(RT.PYPI_INNER_DIRS).replace('(', '[').replace(')', ']')},
                                             split_part(rel_path, '/', 1))) AS i
  FROM src_files
  WHERE strpos(rel_path, '/') > 0 AND split_part(rel_path, '/', 1) IN {O.in_list(RT.PYPI_INNER_DIRS)}
  GROUP BY package, version),
inner_dir AS (SELECT package, version, {O.in_list(RT.PYPI_INNER_DIRS).replace('(', '[').replace(')', ']')}[i] AS inner FROM subs),
inner_files AS (
  SELECT f.package, f.version, f.rel_path AS vrel,
         CASE WHEN d.inner IS NULL THEN f.rel_path ELSE substr(f.rel_path, length(d.inner) + 2) END AS rel_path,
         f.size, f.content
  FROM src_files f LEFT JOIN inner_dir d ON f.package = d.package AND f.version = d.version
  WHERE d.inner IS NULL OR starts_with(f.rel_path, d.inner || '/')),
py_tiers AS (
  SELECT package, version, rel_path, content,
         CASE WHEN rel_path = replace(package, '-', '_') || '/__init__.py'
                   OR ends_with(rel_path, '/' || replace(package, '-', '_') || '/__init__.py') THEN 1
              WHEN strpos({_tp('vrel')}, '/' || replace(package, '-', '_') || '/') > 0 THEN 2
              WHEN starts_with(rel_path, 'src/') AND NOT regexp_matches({_tp('vrel')}, {O.q(FL.PYPI_DENY)}) THEN 3
              WHEN NOT regexp_matches({_tp('vrel')}, {O.q(FL.PYPI_DENY)}) THEN 4 ELSE 5 END AS tier
  FROM inner_files WHERE ends_with(rel_path, '.py')),
py_rep AS (
  SELECT package, version, rel_path, tier, content FROM (
    SELECT *, row_number() OVER (PARTITION BY package, version ORDER BY tier, rel_path) AS rn FROM py_tiers)
  WHERE rn = 1)"""


@register("rep_file_python", f"""{_with('pypi')},
{_PY_INNER_CTE}
SELECT package, version, rel_path, tier FROM py_rep""")
def rep_file_python(spark, sf_dir):
    """C5 + E2: inner root, then one representative .py per PyPI version."""
    chosen = FL.representative_python(RT.pypi_inner_root(_src(spark, sf_dir, "pypi")))
    return chosen.select("package", "version", "rel_path", "tier")


_RB_INNER_CTE = """src_dirs AS (
  SELECT package, version, min(split_part(rel_path, '/', 1)) AS inner FROM src_files
  WHERE strpos(rel_path, '/') > 0 AND ends_with(split_part(rel_path, '/', 1), '.src')
  GROUP BY package, version),
rb_inner AS (
  SELECT f.package, f.version,
         CASE WHEN d.inner IS NULL THEN f.rel_path ELSE substr(f.rel_path, length(d.inner) + 2) END AS rel_path,
         f.content
  FROM src_files f LEFT JOIN src_dirs d ON f.package = d.package AND f.version = d.version
  WHERE d.inner IS NULL OR starts_with(f.rel_path, d.inner || '/')),
rb_rep AS (
  SELECT package, version, rel_path, tier, content FROM (
    SELECT *, row_number() OVER (PARTITION BY package, version ORDER BY tier, rel_path) AS rn FROM (
      SELECT *, CASE WHEN ends_with(rel_path, '.gemspec') THEN 1
                     WHEN starts_with(rel_path, 'lib/') AND ends_with(rel_path, '.rb') THEN 2 ELSE 3 END AS tier
      FROM rb_inner WHERE ends_with(rel_path, '.gemspec') OR ends_with(rel_path, '.rb')))
  WHERE rn = 1)"""


@register("rep_file_ruby", f"""{_with('rubygems')},
{_RB_INNER_CTE}
SELECT package, version, rel_path, tier FROM rb_rep""")
def rep_file_ruby(spark, sf_dir):
    """C5 + E3: *.src root, then gemspec / lib/**/*.rb / any .rb per RubyGems version."""
    chosen = FL.representative_ruby(RT.ruby_inner_root(_src(spark, sf_dir, "rubygems")))
    return chosen.select("package", "version", "rel_path", "tier")


_NPM_ROLLUP_CTE = f"""topk_content AS (
  SELECT t.package, t.version, t.rel_path, t.rank, f.content
  FROM topk t JOIN src_files f ON t.package = f.package AND t.version = f.version AND t.rel_path = f.rel_path),
{_sql_js_features('topk_content', 'content', ('package', 'version', 'rel_path'))},
rollup AS (
  SELECT package, version, list_sort(list_distinct(flatten(list(imports)))) AS imports,
         bool_or(has_eval_exec) AS has_eval_exec, bool_or(calls_os) AS calls_os,
         bool_or(calls_proc) AS calls_proc, CAST(sum(url_count) AS BIGINT) AS url_count,
         CAST(sum(b64_count) AS BIGINT) AS b64_count, CAST(count(*) AS BIGINT) AS n_files
  FROM js_feats GROUP BY package, version)"""


@register("version_rollup", f"""{_with('npm')},
{_TOPK_CTE},
{_NPM_ROLLUP_CTE}
SELECT package, version, array_to_string(imports, ',') AS imports, has_eval_exec, calls_os,
       calls_proc, url_count, b64_count, n_files
FROM rollup""")
def version_rollup(spark, sf_dir):
    """All candidate files' features rolled up per npm version."""
    r = D.npm_version_features(_src(spark, sf_dir, "npm"))
    return r.select("package", "version", F.array_join("imports", ",").alias("imports"),
                    "has_eval_exec", "calls_os", "calls_proc", "url_count", "b64_count", "n_files")


def _sql_npm_parts(r):
    return ("flatten([" + ", ".join([
        _sql_npm_import_phrases(f"coalesce({r}.imports, []::VARCHAR[])"),
        O.flag(f"{r}.calls_os", PH.OS_CALL), O.flag(f"{r}.calls_proc", PH.PROC_CALL),
        O.flag(f"{r}.has_eval_exec", PH.EVAL_PHRASE), O.flag(f"{r}.url_count > 0", PH.URL_PHRASE),
        O.b64_phrases(f"coalesce({r}.b64_count, 0)"), O.flag("h.startup", PH.STARTUP_PHRASE)]) + "])")


# the manifests with an install hook are listed beside their texts, so this oracle
# does not parse JSON as the engine does
_HOOKS_CTE = f"""hooks AS (
  SELECT package, version, content IN {O.in_list(FX.MANIFESTS_WITH_HOOK)} AS startup
  FROM src_files WHERE rel_path = 'package.json')"""


@register("manifest_hooks", f"""{_with('npm')},
{_HOOKS_CTE}
SELECT package, version, startup FROM hooks""")
def manifest_hooks(spark, sf_dir):
    """A9 + G5: install hooks of the package.json at each npm version root."""
    return D.manifest_hooks(_src(spark, sf_dir, "npm"))


@register("npm_sentences", f"""{_with('npm')},
{_TOPK_CTE},
{_NPM_ROLLUP_CTE},
found AS (SELECT DISTINCT package, version FROM src_files),
{_HOOKS_CTE}
SELECT v.package, v.version,
       CASE WHEN fd.package IS NULL THEN {O.fixed_sentence('v.package', 'v.version', D.NO_JS)}
            ELSE {O.sentence('v.package', 'v.version', _sql_npm_parts('r'))} END AS textual_description,
       CAST(v.label AS INTEGER) AS label
FROM versions v
LEFT JOIN found fd ON v.package = fd.package AND v.version = fd.version
LEFT JOIN rollup r ON v.package = r.package AND v.version = r.version
LEFT JOIN hooks h ON v.package = h.package AND v.version = h.version""")
def npm_sentences(spark, sf_dir):
    """L2 npm: label rows → candidate files → rollup → manifest → sentence."""
    return D.npm_descriptions(_labels(spark, sf_dir), _src(spark, sf_dir, "npm"))


def _sql_py_parts():
    call_flags = ", ".join(
        O.flag(f"list_contains(list_transform(p.calls, lambda c: c.mod || ':' || c.func), {O.q(m + ':' + f)})", ph)
        for (m, f), ph in PH.PYPI_CALLS)
    imports = (f"list_transform({O.first_seen(O.no_nulls(f'list_transform(p.imports, lambda i: {O.case_map(chr(105), PH.PYPI_IMPORTS)})'))}, "
               f"lambda x: 'import ' || x)")
    return ("flatten([" + ", ".join([
        imports, call_flags,
        O.flag("len(list_filter(p.calls, lambda c: c.func IN ('eval', 'exec'))) > 0", PH.EVAL_PHRASE),
        O.flag("p.url_count > 0", PH.URL_PHRASE), O.b64_phrases("p.b64_count")]) + "])")


@register("python_sentences", f"""{_with('pypi')},
{_PY_INNER_CTE},
{_sql_py_features('py_rep', 'content', ('package', 'version', 'rel_path'))},
found AS (SELECT DISTINCT package, version FROM src_files)
SELECT v.package, v.version,
       CASE WHEN fd.package IS NULL THEN {O.fixed_sentence('v.package', 'v.version', D.NO_SOURCE)}
            WHEN p.rel_path IS NULL THEN {O.fixed_sentence('v.package', 'v.version', D.NO_PY)}
            ELSE {O.sentence('v.package', "v.version || '/' || p.rel_path", _sql_py_parts())} END
         AS textual_description,
       CAST(v.label AS INTEGER) AS label
FROM versions v
LEFT JOIN found fd ON v.package = fd.package AND v.version = fd.version
LEFT JOIN py_feats p ON v.package = p.package AND v.version = p.version""")
def python_sentences(spark, sf_dir):
    """L2 PyPI: label rows → inner root → representative file → sentence."""
    return D.pypi_descriptions(_labels(spark, sf_dir), _src(spark, sf_dir, "pypi"))


def _sql_rb_parts():
    m = PH.RUBY_REQUIRES
    looked = (f"list_transform(p.requires, lambda r: coalesce({O.case_map('r', m)}, "
              f"{O.case_map(chr(39) + chr(39) + ' || ' + 'array_to_string(string_split(r, ' + chr(39) + '/' + chr(39) + ')[1:2], ' + chr(39) + '/' + chr(39) + ')', m)}))")
    imports = f"list_transform({O.first_seen(O.no_nulls(looked))}, lambda x: 'import ' || x)"
    cue_flags = ", ".join(O.flag(f"len(list_filter(p.calls, lambda c: starts_with(c, {O.q(k)}))) > 0", ph)
                          for k, ph in PH.RUBY_CALLS if ph)
    calls = f"list_sort(list_distinct(flatten([{cue_flags}])))"
    return ("flatten([" + ", ".join([
        imports, calls, O.flag("p.has_eval_exec", PH.EVAL_PHRASE),
        O.flag("p.url_count > 0", PH.URL_PHRASE), O.b64_phrases("p.b64_count")]) + "])")


@register("ruby_sentences", f"""{_with('rubygems')},
{_RB_INNER_CTE},
{_sql_ruby_features('rb_rep', 'content', ('package', 'version', 'rel_path'))},
rb_versions AS (SELECT * FROM versions v WHERE EXISTS (
  SELECT 1 FROM src_files f WHERE f.package = v.package AND f.version = v.version))
SELECT v.package, v.version,
       CASE WHEN p.rel_path IS NULL THEN {O.fixed_sentence('v.package', 'v.version', D.NO_RUBY)}
            ELSE {O.sentence('v.package', "v.version || '/' || p.rel_path", _sql_rb_parts())} END
         AS textual_description,
       CAST(v.label AS INTEGER) AS label
FROM rb_versions v
LEFT JOIN rb_feats p ON v.package = p.package AND v.version = p.version""")
def ruby_sentences(spark, sf_dir):
    """L2 RubyGems: labelled versions (those with a directory) → representative file → sentence."""
    files = _src(spark, sf_dir, "rubygems")
    versions = _labels(spark, sf_dir).join(files.select("package", "version").distinct(),
                                           ["package", "version"], "left_semi")
    return D.ruby_descriptions(versions, files)


# ---------------------------------------------------------------------------
# Step 7: merge, exact stratified split, split counts
# ---------------------------------------------------------------------------
from pkgsift.operators import split as SP  # noqa: E402


def merged_frame(spark, sf_dir):
    return SP.merge_registries(npm=npm_sentences(spark, sf_dir), pypi=python_sentences(spark, sf_dir),
                               rubygems=ruby_sentences(spark, sf_dir)).select(
        "ecosystem", "package", "version", "textual_description", "label")


_MERGED_SQL = "merged AS (\n" + "\nUNION ALL\n".join(
    f"SELECT '{eco}' AS ecosystem, package, version, textual_description, label FROM ({_ORACLES[name]})"
    for eco, name in (("npm", "npm_sentences"), ("pypi", "python_sentences"),
                      ("rubygems", "ruby_sentences"))) + ")"


@register("merged_dataset", f"WITH {_MERGED_SQL}\nSELECT * FROM merged")
def merged_dataset(spark, sf_dir):
    """the three registries' sentences in one table, with an ecosystem column."""
    return merged_frame(spark, sf_dir)


def _split_sql(val=0.10, test=0.10, seed=42, buckets=SP.DEFAULT_BUCKETS):
    vr = val / (1.0 - test)
    key = ("concat_ws(chr(1), coalesce(ecosystem, chr(0)), coalesce(package, chr(0)), coalesce(version, chr(0)), "
           "coalesce(textual_description, chr(0)), coalesce(CAST(label AS VARCHAR), chr(0)))")
    return f"""WITH {_MERGED_SQL},
data AS (SELECT *, md5('{seed}|' || {key}) AS h, {key} AS k FROM merged),
cls AS (SELECT label, count(*) AS n_c FROM data GROUP BY label),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({test!r} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM cls),
t0 AS (SELECT label, n_c, n, n_test, (n_test * n_c) // n AS fl, (n_test * n_c) % n AS rem FROM cls, tot),
t1 AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= n_test - sum(fl) OVER () THEN 1 ELSE 0 END AS n_test_c FROM t0),
v0 AS (SELECT *, n_c - n_test_c AS r, n - n_test AS m,
              CAST(ceil(CAST({vr!r} AS DOUBLE) * (n - n_test)) AS BIGINT) AS n_val FROM t1),
v1 AS (SELECT *, (n_val * r) // m AS vfl, (n_val * r) % m AS vrem FROM v0),
q AS (SELECT label, n_test_c, vfl + CASE WHEN row_number() OVER (ORDER BY vrem DESC, label) <= n_val - sum(vfl) OVER () THEN 1 ELSE 0 END AS n_val_c FROM v1),
ranked AS (SELECT d.*, row_number() OVER (PARTITION BY d.label ORDER BY h, k) AS r FROM data d)
SELECT ecosystem, package, version, textual_description, label,
       CASE WHEN r <= q.n_test_c THEN 'test' WHEN r <= q.n_test_c + q.n_val_c THEN 'validation' ELSE 'train' END AS split
FROM ranked JOIN q USING (label)"""


@register("stratified_split", _split_sql())
def stratified_split(spark, sf_dir):
    """Exact stratified 80/10/10 split of the merged dataset (seed 42)."""
    return SP.stratified_split(merged_frame(spark, sf_dir))


@register("split_counts", f"""WITH s AS ({_split_sql()})
SELECT split, label, CAST(count(*) AS BIGINT) AS rows FROM s GROUP BY split, label""")
def split_counts(spark, sf_dir):
    """Rows per (split, label): the split's sizes and class balance."""
    return SP.split_counts(stratified_split(spark, sf_dir))


@register("split_csv_roundtrip", f"""WITH s AS ({_split_sql()})
SELECT textual_description AS text, CAST(label AS VARCHAR) AS label, split FROM s""")
def split_csv_roundtrip(spark, sf_dir):
    """S1 → A4 + A5 + B8: the split written as pandas-style CSVs (one folder per
    split, in the shared checkpoint folder) and read back as training input."""
    from pkgsift.sources.review_csv import load_split_csv
    from pkgsift.sources.sinks import scratch_folder
    out = scratch_folder(spark, "split-csv")
    SP.write_splits(stratified_split(spark, sf_dir), out, fmt="csv")
    parts = [load_split_csv(spark, SP.split_folder(out, name)).withColumn("split", F.lit(name)) for name in SP.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------------------
# Step 8: prompts, completion parsing, metrics
# ---------------------------------------------------------------------------
from pkgsift.functions import prompts as PR  # noqa: E402
from pkgsift.operators.metrics import detection_metrics as _metrics  # noqa: E402
from pkgsift.sources.review_csv import detect_columns, label_digit  # noqa: E402


def _doc_labels(spark, sf_dir):
    docs = FX.spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang"), "doc_id")
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.join(lab, "doc_id")


@register("prompts", f"""
SELECT d.doc_id,
       {O.q(PR.PROMPT_HEAD)} || d.text || {O.q(PR.PROMPT_TAIL)} || regexp_extract(CAST(l.toxic AS VARCHAR), '([01])', 1) AS text,
       regexp_extract(CAST(l.toxic AS VARCHAR), '([01])', 1) AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE regexp_extract(CAST(l.toxic AS VARCHAR), '([01])', 1) <> '' AND d.text IS NOT NULL""")
def prompts(spark, sf_dir):
    """A5 + B8 + G12: labelled documents → training prompts (label appended)."""
    df = _doc_labels(spark, sf_dir).select("doc_id", "text", F.col("toxic").alias("label"))
    tcol, lcol = detect_columns(df.columns)  # A5: found by name, as in a training CSV
    rows = (df.select("doc_id", F.col(tcol).alias("t"), label_digit(F.col(lcol)).alias("label"))
            .where(F.col("label").isNotNull() & F.col("t").isNotNull()))
    return rows.select("doc_id", PR.build_prompt(F.col("t"), F.col("label")).alias("text"), "label")


@register("first_digit", f"""
SELECT conv_id, turn,
       coalesce(nullif(regexp_extract(string_split(text, {O.q(PR.RESPONSE_MARKER)})[-1], '[01]', 0), ''), '0') AS pred
FROM conversations""")
def first_digit(spark, sf_dir):
    """G13 + G14 on conversation turns: text after the last marker → first 0/1, default 0."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return c.select("conv_id", "turn", PR.prediction(F.col("text")).alias("pred"))


@register("detection_metrics", f"""
WITH p AS (SELECT d.lang, CAST(l.toxic AS VARCHAR) AS y, CAST(l.quality AS VARCHAR) AS p
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT lang, count(*) AS n, count(*) FILTER (WHERE y = p) AS ok,
             count(*) FILTER (WHERE p = '1' AND y = '1') AS tp,
             count(*) FILTER (WHERE p = '1' AND y <> '1') AS fp,
             count(*) FILTER (WHERE p <> '1' AND y = '1') AS fn
      FROM p GROUP BY lang)
SELECT lang, CAST(n AS BIGINT) AS n,
       CASE WHEN n > 0 THEN CAST(ok AS DOUBLE) / n ELSE 0.0 END AS accuracy,
       CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1
FROM c""")
def detection_metrics(spark, sf_dir):
    """D7 per language: truth = toxic, prediction = quality (both as "0"/"1")."""
    df = _doc_labels(spark, sf_dir).select("lang", F.col("toxic").cast("string").alias("label"),
                                           F.col("quality").cast("string").alias("pred"))
    return _metrics(df, group_cols=["lang"])


# ---------------------------------------------------------------------------
# Step 10: completion-only loss mask (R4) and the detector
# ---------------------------------------------------------------------------
@register("loss_mask", f"""
WITH p AS (
  SELECT d.doc_id, {O.q(PR.PROMPT_HEAD)} || d.text || {O.q(PR.PROMPT_TAIL)} || CAST(l.toxic AS VARCHAR) AS prompt
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL),
ids AS (SELECT doc_id, list_transform(string_split(prompt, ''), lambda c: CAST(unicode(c) AS INTEGER)) AS ids FROM p),
t AS (SELECT list_transform(string_split({O.q(PR.RESPONSE_MARKER)}, ''), lambda c: CAST(unicode(c) AS INTEGER)) AS templ),
s AS (SELECT doc_id, ids, list_max(list_filter(range(1, len(ids) - len(templ) + 2),
                                                lambda i: ids[i:i + len(templ) - 1] = templ)) AS start
      FROM ids, t)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens,
       CAST(CASE WHEN start IS NULL THEN len(ids) ELSE start - 1 END AS INTEGER) AS n_masked,
       CAST(start AS INTEGER) AS template_start
FROM s""")
def loss_mask(spark, sf_dir):
    """R4 on character ids of whole training prompts: masked count and template start."""
    df = _doc_labels(spark, sf_dir).where(F.col("text").isNotNull())
    prompt = PR.build_prompt(F.col("text"), F.col("toxic"))
    ids = PR.char_ids(prompt)
    templ = F.array(*[F.lit(ord(c)) for c in PR.RESPONSE_MARKER])
    staged = PR.with_completion_mask(df.select("doc_id", ids.alias("ids")), "ids", templ)
    return staged.select(
        "doc_id", F.size("ids").alias("n_tokens"),
        F.size(F.filter("labels", lambda x: x == PR.IGNORE_INDEX)).alias("n_masked"),
        "template_start")


from pkgsift.plans import detector as DT  # noqa: E402

_BODY = "list_filter(string_split(textual_description, ', '), lambda x, i: i > 1 AND i < len(string_split(textual_description, ', ')))"


@register("detector_scores", f"""WITH s AS ({_split_sql()}),
d AS (SELECT row_number() OVER () AS id, textual_description, label, split, {_BODY} AS ps FROM s WHERE textual_description IS NOT NULL),
vocabulary AS (SELECT unnest([{', '.join(O.q(p) for p in DT.VOCABULARY)}]) AS p),
seen AS (SELECT label, unnest(ps) AS p FROM d WHERE split = 'train'),
counts AS (SELECT v.p, count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0
           FROM vocabulary v LEFT JOIN seen ON v.p = seen.p GROUP BY v.p),
totals AS (SELECT sum(n1) + count(*) AS t1, sum(n0) + count(*) AS t0 FROM counts),
weights AS (SELECT p, ln((n1 + 1.0) / t1) - ln((n0 + 1.0) / t0) AS w FROM counts, totals),
prior AS (SELECT ln((count(*) FILTER (WHERE label = 1) + 1.0) / (count(*) FILTER (WHERE label = 0) + 1.0)) AS a FROM d WHERE split = 'train'),
held AS (SELECT id, textual_description AS text, label, split, unnest(CASE WHEN len(ps) = 0 THEN [''] ELSE ps END) AS p FROM d WHERE split <> 'train'),
scored AS (SELECT id, text, label, split, round((SELECT a FROM prior) + coalesce(sum(w), 0), 9) AS score
           FROM held LEFT JOIN weights ON held.p = weights.p GROUP BY id, text, label, split)
SELECT text, CAST(label AS VARCHAR) AS label, split, CASE WHEN score > 0 THEN '1' ELSE '0' END AS pred FROM scored""")
def detector_scores(spark, sf_dir):
    """Fit the naive Bayes detector on the train split, score validation + test."""
    _, scored, _ = DT.train_and_evaluate(stratified_split(spark, sf_dir))
    return scored


# ---------------------------------------------------------------------------
# Step 6b: version roots (C1-C4) on a derived npm tree with four layouts
# ---------------------------------------------------------------------------

def _npm_name(package):
    """A package's registry name: every eighth is scoped."""
    scoped = F.regexp_extract(package, r"(\d+)$", 1).cast("bigint") % 8 == 4
    return F.when(scoped, F.concat(F.lit("@s/"), package)).otherwise(package)


_NPM_NAME = "CASE WHEN CAST(regexp_extract(package, '(\\d+)$', 1) AS BIGINT) % 8 = 4 THEN '@s/' || package ELSE package END"


def _layout_listing(spark, sf_dir):
    """npm files under four layouts, by package number g % 4:
    0 ``pkg/ver/…``; 1 ``pkg/release-ver-final/…``; 2 ``pkg@ver/…``; 3 ``scope-pkg/ver/…``.
    Of layout 0, every second package stands below a scope, ``@s/pkg/ver/…``."""
    f = _files(spark, sf_dir, "npm")
    g = F.regexp_extract("package", r"(\d+)$", 1).cast("bigint") % 4
    path = (F.when(g == 0, F.concat_ws("/", _npm_name(F.col("package")), "version", "path"))
            .when(g == 1, F.concat_ws("/", "package", F.concat(F.lit("release-"), "version", F.lit("-final")), "path"))
            .when(g == 2, F.concat_ws("/", F.concat_ws("@", "package", "version"), "path"))
            .otherwise(F.concat_ws("/", F.concat(F.lit("scope-"), "package"), "version", "path")))
    return f.select(path.alias("path"), F.length("content").cast("bigint").alias("size"))


@register("version_root_match", f"""WITH {FX.CODE_FILES_SQL},
{_LABELS_CTE},
listing AS (
  SELECT CASE CAST(regexp_extract(package, '(\\d+)$', 1) AS BIGINT) % 4
           WHEN 0 THEN {_NPM_NAME} || '/' || version || '/' || path
           WHEN 1 THEN package || '/release-' || version || '-final/' || path
           WHEN 2 THEN package || '@' || version || '/' || path
           ELSE 'scope-' || package || '/' || version || '/' || path END AS path
  FROM code_files WHERE ecosystem = 'npm'),
parts AS (SELECT string_split(path, '/') AS q, CASE WHEN starts_with(path, '@') THEN [q[1] || '/' || q[2]] || q[3:] ELSE q END AS p FROM listing),
dirs AS (SELECT DISTINCT p[1] AS top, p[2] AS second FROM parts WHERE len(p) >= 3),
tops AS (SELECT DISTINCT p[1] AS top FROM parts WHERE len(p) >= 2),
labs AS (SELECT DISTINCT {_NPM_NAME} AS package, version FROM versions),
pkgs AS (SELECT DISTINCT package FROM labs),
pk_exact AS (SELECT package, package AS pkg_dir FROM pkgs WHERE package IN (SELECT top FROM tops)),
pk_fb AS (
  SELECT package, pkg_dir FROM (
    SELECT k.package, t.top AS pkg_dir,
           row_number() OVER (PARTITION BY k.package ORDER BY length(t.top), t.top) AS rn
    FROM pkgs k JOIN tops t ON ends_with(t.top, string_split(k.package, '/')[-1]) AND NOT contains(t.top, '/')
    WHERE k.package NOT IN (SELECT package FROM pk_exact)) WHERE rn = 1),
lab2 AS (SELECT l.package, l.version, coalesce(e.pkg_dir, f.pkg_dir) AS pkg_dir
         FROM labs l LEFT JOIN pk_exact e ON l.package = e.package LEFT JOIN pk_fb f ON l.package = f.package),
v_exact AS (SELECT l.package, l.version, l.pkg_dir AS root_top, l.version AS root_second
            FROM lab2 l JOIN dirs d ON d.top = l.pkg_dir AND d.second = l.version),
rest AS (SELECT l.* FROM lab2 l ANTI JOIN v_exact v ON l.package = v.package AND l.version = v.version),
v_c2 AS (
  SELECT package, version, root_top, root_second FROM (
    SELECT r.package, r.version, d.top AS root_top, d.second AS root_second,
           row_number() OVER (PARTITION BY r.package, r.version ORDER BY length(d.second), d.second) AS rn
    FROM rest r JOIN dirs d ON d.top = r.pkg_dir AND contains(d.second, r.version)) WHERE rn = 1),
rest2 AS (SELECT r.* FROM rest r ANTI JOIN v_c2 v ON r.package = v.package AND r.version = v.version),
v_c4 AS (SELECT package, version, package || '@' || version AS root_top, CAST(NULL AS VARCHAR) AS root_second
         FROM rest2 WHERE package || '@' || version IN (SELECT top FROM tops)),
found AS (SELECT * FROM v_exact UNION ALL SELECT * FROM v_c2 UNION ALL SELECT * FROM v_c4)
SELECT l.package, l.version,
       CASE WHEN f.root_second IS NULL THEN f.root_top ELSE f.root_top || '/' || f.root_second END AS root
FROM labs l LEFT JOIN found f ON l.package = f.package AND l.version = f.version""")
def version_root_match(spark, sf_dir):
    """Label rows → version roots (exact, contains, name fallback, pkg@ver)."""
    labs = _labels(spark, sf_dir).select(_npm_name(F.col("package")).alias("package"), "version").distinct()
    r = RT.resolve_roots(labs, _layout_listing(spark, sf_dir), "npm")
    root = F.when(F.col("root_second").isNull(), F.col("root_top")).otherwise(
        F.concat_ws("/", "root_top", "root_second"))
    return r.select("package", "version", root.alias("root"))


@register("root_files", f"""WITH {FX.CODE_FILES_SQL}
SELECT {_NPM_NAME} AS package, version, path AS rel_path, CAST(length(content) AS BIGINT) AS size
FROM code_files WHERE ecosystem = 'npm'""")
def root_files(spark, sf_dir):
    """C1-C4 + file mapping: every npm file found again under its resolved root."""
    listing = _layout_listing(spark, sf_dir)
    versions = _files(spark, sf_dir, "npm").select(_npm_name(F.col("package")).alias("package"), "version").distinct()
    roots = RT.resolve_roots(versions, listing, "npm")
    return RT.files_under_roots(roots, listing).select("package", "version", "rel_path", "size")


@register("version_root_match_pypi", f"""WITH {FX.CODE_FILES_SQL},
{_LABELS_CTE},
known AS (SELECT DISTINCT package, version, CAST(regexp_extract(package, '(\\d+)$', 1) AS BIGINT) % 4 AS k FROM code_files WHERE ecosystem = 'pypi'),
dirs AS (SELECT CASE k WHEN 2 THEN package || '@' || version WHEN 3 THEN package || '_x' ELSE package END AS top,
                CASE k WHEN 1 THEN 'release-' || version || '-final' WHEN 2 THEN NULL ELSE version END AS second FROM known),
labs AS (SELECT DISTINCT v.package, v.version FROM versions v JOIN known USING (package, version)),
pkgs AS (SELECT package, arg_min(top, (top <> package, length(top), top)) AS pkg_dir
         FROM (SELECT DISTINCT package FROM labs) JOIN (SELECT DISTINCT top FROM dirs) ON starts_with(top, package) GROUP BY package),
found AS (SELECT l.package, l.version, arg_min(d.top || '/' || d.second, (d.second <> l.version, length(d.second), d.second)) AS root
          FROM labs l JOIN pkgs p ON l.package = p.package JOIN dirs d ON d.top = p.pkg_dir AND contains(d.second, l.version)
          GROUP BY l.package, l.version)
SELECT l.package, l.version, f.root FROM labs l LEFT JOIN found f USING (package, version)""")
def version_root_match_pypi(spark, sf_dir):
    """C1-C3 for PyPI, by package number % 4: exact, contains, ``pkg@ver`` (no layout
    of PyPI: no root), a directory that starts with the name; empty versions too."""
    known = _files(spark, sf_dir, "pypi").select("package", "version").distinct()
    k = F.regexp_extract("package", r"(\d+)$", 1).cast("bigint") % 4
    path = (F.when(k == 0, F.concat_ws("/", "package", "version"))
            .when(k == 1, F.concat_ws("/", "package", F.concat(F.lit("release-"), "version", F.lit("-final"))))
            .when(k == 2, F.concat_ws("@", "package", "version")).otherwise(F.concat(F.col("package"), F.lit("_x/"), F.col("version"))))
    listing = known.select(path.alias("path"), F.lit(True).alias("is_dir"))  # directories without files
    labs = _labels(spark, sf_dir).select("package", "version").distinct().join(known, ["package", "version"], "left_semi")
    r = RT.resolve_roots(labs, listing, "pypi")
    root = F.when(F.col("root_top").isNotNull(), F.concat_ws("/", "root_top", "root_second"))
    return r.select("package", "version", root.alias("root"))


# ---------------------------------------------------------------------------
# Archives (A10, A11, R6, B11) and the label and result files
# ---------------------------------------------------------------------------
from pkgsift.sources import archives as AR  # noqa: E402
from pkgsift.sources import sinks as SK  # noqa: E402
from pkgsift.sources import review_csv as RC  # noqa: E402


@register("archive_members", f"""WITH {FX.CODE_FILES_SQL}
SELECT package, version, package || '-' || version || '/' || path AS member, CAST(length(content) AS BIGINT) AS size, md5(content) AS digest
FROM code_files WHERE ecosystem = 'pypi' AND content IS NOT NULL
UNION ALL
SELECT package, version, path, CAST(length(content) AS BIGINT), md5(content) FROM code_files WHERE ecosystem = 'rubygems' AND content IS NOT NULL""")
def archive_members(spark, sf_dir):
    """Members of one tar.gz, tgz, zip or gem per version, read in the tasks."""
    packed = FX.archives(spark, sf_dir, "pypi").unionByName(FX.archives(spark, sf_dir, "rubygems"))
    found = AR.expand_archives(packed, (".py", ".rb")).where("member is not null and error is null")
    return found.select("package", "version", "member", "size", F.md5("content").alias("digest"))


def _packed(spark, sf_dir, ecosystem):
    """The archives, built once and stored."""
    return SP._stored(FX.archives(spark, sf_dir, ecosystem).withColumn("size", F.octet_length("bytes").cast("bigint")), "archives")


def _expand_fixture(packed, suffixes):
    def expand(chosen):
        return AR.expand_archives(packed.drop("size").join(chosen, ["package", "version", "path"], "left_semi"), suffixes)

    return expand


def _archive_listing(packed):
    """A listing in which every version holds its archive only."""
    return packed.select("package", "version", "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("rel_path"), "size")


_PACKED_REP = f"""packed AS (
  SELECT package, version, package || '-' || version || '/' || path AS rel_path, content,
         replace(package, '-', '_') AS hint FROM code_files WHERE ecosystem = 'pypi' AND content IS NOT NULL),
tiers AS (
  SELECT *, CASE WHEN ends_with(rel_path, '/' || hint || '/__init__.py') THEN 1 WHEN contains('/' || rel_path, '/' || hint || '/') THEN 2
                 WHEN starts_with(rel_path, 'src/') AND NOT regexp_matches('/' || rel_path, {O.q(FL.PYPI_DENY)}) THEN 3
                 WHEN NOT regexp_matches('/' || rel_path, {O.q(FL.PYPI_DENY)}) THEN 4 ELSE 5 END AS tier FROM packed),
py_rep AS (SELECT package, version, rel_path, content FROM (
  SELECT *, row_number() OVER (PARTITION BY package, version ORDER BY tier, rel_path) AS rn FROM tiers) WHERE rn = 1)"""


@register("pypi_archive_sentences", f"""WITH {FX.CODE_FILES_SQL},
{_LABELS_CTE},
{_PACKED_REP},
{_sql_py_features('py_rep', 'content', ('package', 'version', 'rel_path'))}
SELECT v.package, v.version, {O.sentence('v.package', "v.version || '/' || p.rel_path", _sql_py_parts())} AS textual_description,
       CAST(v.label AS INTEGER) AS label
FROM versions v JOIN py_feats p ON v.package = p.package AND v.version = p.version""")
def pypi_archive_sentences(spark, sf_dir):
    """A10: PyPI versions that hold an archive only: its members give the sentence."""
    packed = _packed(spark, sf_dir, "pypi")
    listing = _archive_listing(packed)
    labels = _labels(spark, sf_dir).join(listing.select("package", "version"), ["package", "version"], "left_semi")
    none = lambda rows: rows.withColumn("content", F.lit(None).cast("string"))  # noqa: E731  no loose .py file to read
    return D.pypi_descriptions(labels, listing, read=none, expand=_expand_fixture(packed, (".py",)))


@register("gem_sentences", f"""WITH {FX.CODE_FILES_SQL},
src_files AS (SELECT package, version, path AS rel_path, content FROM code_files WHERE ecosystem = 'rubygems' AND content IS NOT NULL),
{_LABELS_CTE},
{_RB_INNER_CTE},
{_sql_ruby_features('rb_rep', 'content', ('package', 'version', 'rel_path'))}
SELECT v.package, v.version, {O.sentence('v.package', "v.version || '/' || p.rel_path", _sql_rb_parts())} AS textual_description,
       CAST(v.label AS INTEGER) AS label
FROM versions v JOIN rb_feats p ON v.package = p.package AND v.version = p.version""")
def gem_sentences(spark, sf_dir):
    """RubyGems versions that hold a .gem only: its members give the sentence."""
    packed = _packed(spark, sf_dir, "rubygems")
    listing = _archive_listing(packed)
    versions = _labels(spark, sf_dir).join(listing.select("package", "version"), ["package", "version"], "left_semi")
    none = lambda rows: rows.withColumn("content", F.lit(None).cast("string"))
    return D.ruby_descriptions(versions, listing, read=none, expand=_expand_fixture(packed, (".rb", ".gemspec")))


@register("review_csv_labels", f"""{_ROWS_SQL},
classified AS (SELECT package, version, {_label_case_sql('benign')} AS label FROM rows)
SELECT DISTINCT package, version, label FROM classified WHERE label IS NOT NULL""")
def review_csv_labels(spark, sf_dir):
    """A1 + A2: the review rows written as CSV with other column names, read back and labelled."""
    out = SK.scratch_folder(spark, "review-csv")
    SK.write_table(FX.package_info(spark, sf_dir).toDF("package_name", "ver", "threat"), out, "csv")
    return L.build_labels(RC.read_review_info(spark, out, "npm"), "benign").versions


@register("label_tables_roundtrip", f"""{_LABELS_CTE.replace('rows AS', 'rows AS', 1) if _LABELS_CTE.startswith('WITH') else 'WITH ' + _LABELS_CTE}
SELECT 'labels_version' AS tab, package, version, CAST(label AS INTEGER) AS label FROM versions
UNION ALL SELECT 'labels', package, NULL, CAST(max(label) AS INTEGER) FROM versions GROUP BY package""")
def label_tables_roundtrip(spark, sf_dir):
    """S2, E6 + A3: the label tables written as ordered CSVs and read back."""
    out = SK.scratch_folder(spark, "label-tables")
    SK.write_label_tables(L.build_labels(resolve_review_columns(FX.package_info(spark, sf_dir), "npm"), "drop"), out)
    versions = RC.read_version_labels(spark, f"{out}/labels_version")
    packages = RC.read_csv_strings(spark, f"{out}/labels")
    return (versions.select(F.lit("labels_version").alias("tab"), "package", "version", "label")
            .unionByName(packages.select(F.lit("labels").alias("tab"), "package", F.lit(None).cast("string").alias("version"), F.col("label").cast("int"))))


@register("predictions_roundtrip", f"""SELECT text, label, pred FROM ({_ORACLES['detector_scores']}) WHERE split = 'test'""")
def predictions_roundtrip(spark, sf_dir):
    """S3: the detector's test predictions written as CSV and read back."""
    out = SK.scratch_folder(spark, "predictions")
    SK.write_predictions(detector_scores(spark, sf_dir).where("split = 'test'"), out)
    return RC.read_csv_strings(spark, out).select("text", "label", "pred")
