"""Phrase dictionaries (G15) and lookups.

The dictionaries are tiny and fixed, so they are literal maps inside the
expression (no join at all).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Phrase dictionaries, in the reference's order.
NPM_IMPORTS = {
    "http": "network module", "https": "network module", "net": "network module",
    "dns": "network module", "dgram": "network module", "tls": "network module",
    "fs": "file system module", "path": "file system module", "os": "operating system module",
    "child_process": "process module", "vm": "code utility module", "crypto": "code utility module",
    "axios": "network module", "node-fetch": "network module", "got": "network module",
    "request": "network module",
}
# The reference also lists "os.path"; imports are cut at the first '.', so that
# key can never be looked up and is left out.
PYPI_IMPORTS = {
    "os": "operating system module", "subprocess": "process module", "base64": "base64 module",
    "requests": "network module", "urllib": "network module", "urllib3": "network module",
    "socket": "network module", "http": "network module", "ftplib": "network module",
    "telnetlib": "network module", "paramiko": "network module", "operator": "operator module",
    "codecs": "code utility module", "code": "code utility module", "sys": "system module",
    "shutil": "file system module", "pathlib": "file system module",
    "ctypes": "native interface module",
}
PYPI_CALLS = [  # (module, function) → phrase; order is the sentence order
    (("os", "system"), "use operating system module call"),
    (("subprocess", "Popen"), "use process module call"),
    (("subprocess", "run"), "use process module call"),
    (("subprocess", "call"), "use process module call"),
    (("subprocess", "check_call"), "use process module call"),
    (("subprocess", "check_output"), "use process module call"),
]
RUBY_REQUIRES = {
    "net/http": "network module", "open-uri": "network module", "socket": "network module",
    "openssl": "network module", "uri": "network module", "rest-client": "network module",
    "httpclient": "network module", "net/ftp": "network module", "open3": "process module",
    "fileutils": "file system module", "tempfile": "file system module",
    "base64": "base64 module",
}
RUBY_CALLS = [  # cue prefix → phrase (None: described by the eval flag instead)
    ("system", "use operating system module call"),
    ("exec", "use operating system module call"),
    ("spawn", "use operating system module call"),
    ("open3.popen", "use process module call"),
    ("io.popen", "use process module call"),
    ("eval", None), ("instance_eval", None), ("class_eval", None), ("module_eval", None),
]
OS_CALL = "use operating system module call"
PROC_CALL = "use process module call"
EVAL_PHRASE = "evaluate code at run-time"
URL_PHRASE = "use URL"
STARTUP_PHRASE = "modify startup behavior"
# ---------------------------------------------------------------------------


def literal_map(d: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def lookup(d: dict, key: Column) -> Column:
    return F.try_element_at(literal_map(d), key)


def import_phrases(imports: Column, d: dict, base_fn=None) -> Column:
    """E5: sorted imports → 'import <phrase>' list, first-seen order, no repeats.

    With ``base_fn`` a miss retries on the base name (npm, Ruby).
    """
    m = literal_map(d)

    def phrase(imp):
        hit = F.try_element_at(m, imp)
        return F.coalesce(hit, F.try_element_at(m, base_fn(imp))) if base_fn else hit

    looked = F.transform(F.array_sort(imports), phrase)
    kept = F.array_distinct(F.filter(looked, lambda p: p.isNotNull()))
    return F.transform(kept, lambda p: F.concat(F.lit("import "), p))
