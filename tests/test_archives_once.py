"""Archives of a registry are opened once, whatever the sides of the plan that need them."""

from pkgsift.plans import describe as D
from tests.conftest import rows


def test_gems_are_opened_once(spark):
    opened = spark.sparkContext.accumulator(0)
    kinds = "package string, version string, path string, member string, size long, content binary, error string"

    def members(batches):
        for pdf in batches:
            out = []
            for package, version, path in zip(pdf["package"], pdf["version"], pdf["path"]):
                opened.add(1)
                if package != "empty":
                    out.append((package, version, path, "lib/z.rb", 1, b"puts 1", None))
                    out.append((package, version, path, "lib/a.rb", 1, b'require "socket"', None))
                out.append((package, version, path, None, None, None, "damaged" if package == "bad" else None))
            yield pdf.__class__(out, columns=["package", "version", "path", "member", "size", "content", "error"])

    listing = [(p, "1", f"{p}.gem", f"{p}/1/{p}.gem", 1, None) for p in ("good", "bad", "empty")]
    listing += [(p, "1", "own.rb", f"{p}/1/own.rb", 1, b"exec('x')") for p in ("good", "bad", "empty")]
    files = spark.createDataFrame(listing, "package string, version string, rel_path string, path string, size long, content binary")
    found = D.ruby_file_features(files, expand=lambda chosen: chosen.mapInPandas(members, kinds))
    got = {r[0]: (r[1], r[2], r[3]) for r in rows(found.select("package", "rel_path", "requires", "calls"))}
    # a broken gem leaves the loose files, one read to its end replaces them
    assert got == {"good": ("lib/a.rb", ["socket"], []), "bad": ("own.rb", [], ["exec"])}
    assert opened.value == 3
