"""JavaScript / TypeScript file features and the npm sentence.

Aliases come from six ordered regex passes; a later match wins, so entries
keep their pass order and lookups take the last entry with the key.  Calls
come from one pass over the text (``lexers.js_scan``).  With ``max_file_bytes`` given,
files above it are never scanned: they take the light path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pkgsift.functions import evidence as EV
from pkgsift.functions import lexers as LX
from pkgsift.functions import phrases as PH
from pkgsift.functions.colcache import apply_stages, cached_columns
from pkgsift.functions.tags import strip_blanks

# ---------------------------------------------------------------------------
# The reference's alias patterns, pass order preserved.  The
# brace lists use a possessive `\{([^\}]++)\}` (items are trimmed later), so
# an unclosed brace followed by blanks cannot backtrack cubically.
REQUIRE_ALIAS = (r"(?U)\b(?:const|let|var)\s++([A-Za-z_$][\w$]*+)\s*+=\s*+require\s*+\(\s*+"
                 r"['\"]([^'\"]++)['\"]\s*+\)")
REQUIRE_DESTRUCT = (r"(?U)\b(?:const|let|var)\s*+\{([^\}]++)\}\s*+=\s*+require\s*+\(\s*+"
                    r"['\"]([^'\"]++)['\"]\s*+\)")
IMPORT_DEFAULT = r"(?U)\bimport\s++([A-Za-z_$][\w$]*+)\s++from\s++['\"]([^'\"]++)['\"]"
IMPORT_NAMESPACE = r"(?U)\bimport\s++\*\s++as\s++([A-Za-z_$][\w$]*+)\s++from\s++['\"]([^'\"]++)['\"]"
IMPORT_NAMED = r"(?U)\bimport\s*+\{([^\}]++)\}\s*+from\s*+['\"]([^'\"]++)['\"]"
IMPORT_BARE = r"(?U)\bimport\s*+['\"]([^'\"]++)['\"]"
# Light-mode and parse-failure regexes (run on the lower-cased text).
EVAL_CALL = r"(?U)\beval\s*+\("
NEW_FUNCTION = r"(?U)\bnew\s++function\s*+\("
VM_RUN = r"(?U)\bvm\s*+\.\s*+runinnewcontext\s*+\("
DIRECT_REQUIRE_OS = r"require\s*+\(\s*+['\"]child_process['\"]\s*+\)\s*+\.?\s*+exec(?:sync)?\s*+\("
DIRECT_REQUIRE_PROC = r"require\s*+\(\s*+['\"]child_process['\"]\s*+\)\s*+\.?\s*+(?:spawn|fork)\s*+\("
MODULE_CP_OS = r"(?U)\bchild_process\s*+\.\s*+exec(?:sync)?\s*+\("
MODULE_CP_PROC = r"(?U)\bchild_process\s*+\.\s*+(?:spawn|fork)\s*+\("
PROCESS_MODULES = ["child_process", "cp"]
OS_FUNCS = ["exec", "execsync"]
PROC_FUNCS = ["spawn", "fork"]
INSTALL_HOOKS = ["preinstall", "install", "postinstall"]
REFERENCE_MAX_FILE_BYTES = 2_000_000
# Size gate of the light path: 0 is no gate; a caller may pass one.
DEFAULT_MAX_FILE_BYTES = 0
# Opt-in extensions (Q12, extended=True; not in the reference): `node:` module
# prefixes, `import d, {x} from`, bare `require()`, dynamic `import()`, and
# execFile / execFileSync / spawnSync as process calls.
DEFAULT_AND_NAMED = (r"(?U)\bimport\s++([A-Za-z_$][\w$]*+)\s*+,\s*+\{([^\}]++)\}\s*+from\s*+"
                     r"['\"]([^'\"]++)['\"]")
BARE_REQUIRE = r"(?U)\brequire\s*+\(\s*+['\"]([^'\"]++)['\"]\s*+\)"
DYNAMIC_IMPORT = r"(?U)\bimport\s*+\(\s*+['\"]([^'\"]++)['\"]\s*+\)"
EXTENDED_OS_FUNCS = ["execfile", "execfilesync"]
EXTENDED_PROC_FUNCS = ["spawnsync"]
# ---------------------------------------------------------------------------


def _mod(m: Column) -> Column:
    return F.lower(strip_blanks(m))


def _mod_ext(m: Column) -> Column:
    return F.regexp_replace(_mod(m), "^node:", "")


def _guarded(text: Column, keyword: str, arr: Column) -> Column:
    """Skip a full-text regex scan when its keyword does not occur at all."""
    return F.when(F.instr(text, keyword) > 0, arr).otherwise(F.array().cast("array<string>"))


def _pairs(text: Column, pattern: str, norm=_mod) -> Column:
    """All matches of a two-group pattern as array<struct<a, m>>, in text order.

    One scan of the text for whole matches; the groups are then re-read from
    each (short) match, which gives the same groups since no pattern looks
    past its own end.
    """
    keyword = "require" if "require" in pattern else "import"
    whole = _guarded(text, keyword, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.transform(whole, lambda w: F.struct(F.regexp_extract(w, pattern, 1).alias("a"),
                                                 norm(F.regexp_extract(w, pattern, 2)).alias("m")))


def _triples(text: Column, pattern: str, norm) -> Column:
    """``import d, {x as y} from 'm'`` matches → array<struct<a, n, m>>."""
    whole = _guarded(text, "import", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.transform(whole, lambda w: F.struct(F.regexp_extract(w, pattern, 1).alias("a"),
                                                 F.regexp_extract(w, pattern, 2).alias("n"),
                                                 norm(F.regexp_extract(w, pattern, 3)).alias("m")))


def _alias_entries(passes) -> Column:
    """alias → module entries from passes 1, 3 and 4, in insertion order."""
    return F.concat(*[F.transform(passes[i], lambda e: F.struct(e["a"].alias("k"),
                                                               e["m"].alias("mod")))
                      for i in (0, 2, 3)])


def _items(names: Column) -> Column:
    return F.filter(F.transform(F.split(names, ","), strip_blanks), lambda i: i != "")


def _destruct_entries(pairs: Column) -> Column:
    """``{orig: al, x}`` → (al, mod, orig), (x, mod, x)."""
    def one(e):
        def item(i):
            has = F.instr(i, ":") > 0
            orig = strip_blanks(F.substring_index(i, ":", 1))
            al = strip_blanks(F.regexp_extract(i, r"(?s)^[^:]*:(.*)$", 1))
            return F.struct(F.when(has, al).otherwise(i).alias("k"), e["m"].alias("mod"),
                            F.when(has, orig).otherwise(i).alias("fn"))
        return F.transform(_items(e["a"]), item)
    return F.flatten(F.transform(pairs, one))


def _named_entries(pairs: Column) -> Column:
    """``{orig as al, x}`` → (al, mod, orig), (x, mod, x)."""
    def one(e):
        def item(i):
            has = i.rlike(r"(?U)\sas\s")
            orig = strip_blanks(F.regexp_extract(i, r"(?sU)^(.*?)\sas\s", 1))
            al = strip_blanks(F.regexp_extract(i, r"(?sU)^.*?\sas\s(.*)$", 1))
            return F.struct(F.when(has, al).otherwise(i).alias("k"), e["m"].alias("mod"),
                            F.when(has, orig).otherwise(i).alias("fn"))
        return F.transform(_items(e["a"]), item)
    return F.flatten(F.transform(pairs, one))


def _imports(passes, bare: Column, norm=_mod) -> Column:
    mods = F.concat(*[F.transform(p, lambda e: e["m"]) for p in passes],
                    F.transform(bare, norm))
    return F.array_sort(F.array_distinct(mods))


PAIR_PATTERNS = [REQUIRE_ALIAS, REQUIRE_DESTRUCT, IMPORT_DEFAULT, IMPORT_NAMESPACE, IMPORT_NAMED]


@cached_columns
def _alias_stages(text_col: str, extended: bool = False):
    text = F.col(text_col)
    norm = _mod_ext if extended else _mod
    passes = [F.col(f"_p{i}") for i in range(len(PAIR_PATTERNS))]
    first = {f"_p{i}": _pairs(text, p, norm) for i, p in enumerate(PAIR_PATTERNS)}
    first["_bare"] = _guarded(text, "import", F.regexp_extract_all(text, F.lit(IMPORT_BARE), F.lit(1)))
    drop = [f"_p{i}" for i in range(len(PAIR_PATTERNS))] + ["_bare"]
    aliases = _alias_entries(passes)
    names = F.concat(_destruct_entries(passes[1]), _named_entries(passes[4]))
    bare = F.col("_bare")
    if extended:
        first["_dn"] = _triples(text, DEFAULT_AND_NAMED, norm)
        first["_req"] = _guarded(text, "require", F.regexp_extract_all(text, F.lit(BARE_REQUIRE), F.lit(1)))
        first["_dyn"] = _guarded(text, "import", F.regexp_extract_all(text, F.lit(DYNAMIC_IMPORT), F.lit(1)))
        dn = F.col("_dn")
        aliases = F.concat(aliases, F.transform(dn, lambda e: F.struct(e["a"].alias("k"), e["m"].alias("mod"))))
        names = F.concat(names, _named_entries(
            F.transform(dn, lambda e: F.struct(e["n"].alias("a"), e["m"].alias("m")))))
        bare = F.concat(bare, F.col("_req"), F.col("_dyn"))
        passes = passes + [F.transform(dn, lambda e: F.struct(e["a"].alias("a"), e["m"].alias("m")))]
        drop += ["_dn", "_req", "_dyn"]
    second = {"imports": _imports(passes, bare, norm), "_aliases": aliases, "_names": names}
    return [first, second], drop


def with_aliases(df: DataFrame, text_col: str = "text", extended: bool = False) -> DataFrame:
    """Add ``imports`` plus the alias (``_aliases``) and name (``_names``) entries."""
    stages, drop = _alias_stages(text_col, extended)
    return apply_stages(df, stages, drop)


def _last(entries: Column, key: Column) -> Column:
    """Last entry whose key equals ``key`` (later matches win), else null."""
    return F.try_element_at(F.filter(entries, lambda e: e["k"] == key), F.lit(-1))


def resolve_calls(raw: Column, aliases: Column, names: Column) -> Column:
    """Scanned calls → array<struct<mod, func, start, stop, mentions>> through the alias maps."""
    def one(c):
        hit = _last(aliases, c["base"])
        mod0 = F.when(c["base"] != "", F.coalesce(hit["mod"], c["base"])).otherwise(F.lit(""))
        nf = _last(names, c["func"])
        use_nf = (mod0 == "") & nf.isNotNull()
        return F.struct(F.when(use_nf, nf["mod"]).otherwise(mod0).alias("mod"),
                        F.when(use_nf, nf["fn"]).otherwise(c["func"]).alias("func"),
                        c["start"].alias("start"), c["stop"].alias("stop"), c["mentions"].alias("mentions"))
    return F.transform(raw, one)


@cached_columns
def _js_stages(text_col: str, size_col: str | None, max_file_bytes: int, max_tokens: int,
               lenient: bool | str, extended: bool = False, path_col: str | None = None):
    text = F.col(text_col)
    low = F.lower(text)
    size = F.col(size_col) if size_col else F.length(text)
    light = (F.lit(max_file_bytes > 0) & (size > F.lit(max_file_bytes))) if max_file_bytes else F.lit(False)
    typed = F.coalesce(F.lower(F.col(path_col)).endswith(".ts"), F.lit(False)) if path_col else F.lit(False)
    is_light = F.col("light")
    alias_stages, alias_drop = _alias_stages(text_col, extended)
    os_funcs = OS_FUNCS + (EXTENDED_OS_FUNCS if extended else [])
    proc_funcs = PROC_FUNCS + (EXTENDED_PROC_FUNCS if extended else [])
    s0 = {"light": light}
    # a light file is an empty text to the scan
    s1 = {"_scan": LX.js_scan(F.when(~is_light, text), typed, max_tokens)}
    scan = F.col("_scan")
    s3 = {"_calls": resolve_calls(scan["calls"], F.col("_aliases"), F.col("_names"))}
    c = F.col("_calls")
    tree_eval = F.exists(c, lambda x: F.lower(x["func"]) == "eval")
    # the module is a process module, or there is none and the call's text names child_process
    def runs(funcs):
        return F.exists(c, lambda x: (x["mod"].isin(PROCESS_MODULES) | ((x["mod"] == "") & x["mentions"])) & F.lower(x["func"]).isin(funcs))
    tree_os, tree_proc = runs(os_funcs), runs(proc_funcs)
    direct_os = low.rlike(DIRECT_REQUIRE_OS)
    direct_proc = low.rlike(DIRECT_REQUIRE_PROC)
    light_eval = low.rlike(EVAL_CALL) | low.rlike(VM_RUN)
    if lenient:  # G24 parse-failure set, as an opt-in extra
        where = scan["broken"] if lenient == "broken" else F.lit(True)
        tree_eval = tree_eval | (where & (low.rlike(EVAL_CALL) | low.rlike(NEW_FUNCTION) | low.rlike(VM_RUN)))
        tree_os = tree_os | (where & low.rlike(MODULE_CP_OS))
        tree_proc = tree_proc | (where & low.rlike(MODULE_CP_PROC))
    s4 = {"calls": F.transform(c, lambda x: F.struct(x["mod"].alias("mod"), x["func"].alias("func"))),
          "has_eval_exec": F.when(is_light, light_eval).otherwise(tree_eval),
          "calls_os": F.when(is_light, direct_os).otherwise(tree_os),
          "calls_proc": F.when(is_light, direct_proc).otherwise(tree_proc),
          "url_count": F.when(is_light, EV.url_count(text)).otherwise(scan["urls"]),
          "b64_count": F.when(is_light, EV.b64_count(text)).otherwise(scan["b64"])}
    return [s0, s1, *alias_stages, s3, s4], alias_drop + ["_scan", "_aliases", "_names", "_calls"]


def js_features(df: DataFrame, text_col: str = "text", size_col: str | None = "size",
                max_file_bytes: int = DEFAULT_MAX_FILE_BYTES,
                max_tokens: int = LX.DEFAULT_MAX_TOKENS, lenient: bool | str = False,
                extended: bool = False, path_col: str | None = None) -> DataFrame:
    """Add imports, calls, has_eval_exec, calls_os, calls_proc, url_count,
    b64_count and ``light`` (true when the file took the light path).

    ``lenient`` adds the reference's parse-failure regexes (G24), to every file or
    (``"broken"``) to those whose brackets, literals or comments don't close;
    ``extended`` the Q12 extensions (both off by default, as in the reference).
    Files whose ``path_col`` ends in .ts are read as TypeScript."""
    LX.ready(df)
    stages, drop = _js_stages(text_col, size_col, max_file_bytes, max_tokens, lenient, extended, path_col)
    return apply_stages(df, stages, drop)


def js_call_texts(df: DataFrame, text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """One row per call, in the order of their brackets: ``call_index``, ``mod``,
    ``func`` and ``call_text``, the whole call with what it is chained to and its
    arguments.  A chain's texts add up to the square of its length; flags need none of them."""
    LX.ready(df)
    typed = F.coalesce(F.lower(F.col(path_col)).endswith(".ts"), F.lit(False)) if path_col else F.lit(False)
    found = with_aliases(df, text_col).withColumn("_scan", LX.js_scan(F.col(text_col), typed))
    calls = resolve_calls(F.col("_scan.calls"), F.col("_aliases"), F.col("_names"))
    return (found.select(*df.columns, F.posexplode(calls).alias("call_index", "_call"))
            .select(*df.columns, "call_index", F.col("_call.mod").alias("mod"), F.col("_call.func").alias("func"),
                    F.col(text_col).substr(F.col("_call.start") + 1, F.col("_call.stop") - F.col("_call.start")).alias("call_text")))


def install_hook(manifest_json: Column) -> Column:
    """``scripts`` object has preinstall/install/postinstall (key presence).

    Bad JSON, a leading BOM and a non-object ``scripts`` all give false.  Of equal
    keys the last counts, so the session must allow them (``allow_repeated_keys``).
    """
    scripts = F.try_variant_get(F.try_parse_json(manifest_json), "$.scripts",
                                "map<string,variant>")
    return F.coalesce(F.exists(F.map_keys(scripts), lambda k: k.isin(INSTALL_HOOKS)),
                      F.lit(False))


def allow_repeated_keys(spark) -> None:
    """Parse JSON objects with equal keys, the last one counting, as JSON parsers
    commonly do; Spark's default refuses the whole text, which a hostile manifest
    could use to hide its hooks."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def npm_parts(imports: Column, calls_os: Column, calls_proc: Column, has_eval: Column,
              url_n: Column, b64_n: Column, startup: Column) -> Column:
    return F.concat(
        PH.import_phrases(imports, PH.NPM_IMPORTS, EV.module_base),
        EV.flag_phrase(calls_os, PH.OS_CALL),
        EV.flag_phrase(calls_proc, PH.PROC_CALL),
        EV.flag_phrase(has_eval, PH.EVAL_PHRASE),
        EV.flag_phrase(url_n > 0, PH.URL_PHRASE),
        EV.base64_phrases(b64_n),
        EV.flag_phrase(startup, PH.STARTUP_PHRASE))


def npm_sentence(package: Column, version: Column, imports: Column, calls_os: Column,
                 calls_proc: Column, has_eval: Column, url_n: Column, b64_n: Column,
                 startup: Column) -> Column:
    """``start entry {pkg}/{version}, ..., end of entry``."""
    return EV.sentence(package, version, npm_parts(imports, calls_os, calls_proc, has_eval,
                                                   url_n, b64_n, startup))
