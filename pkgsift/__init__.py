"""pkgsift: supply-chain threat datasets as Spark DataFrame jobs.

Stages (every one is a lazy DataFrame plan):

* ``sources``   – review CSVs, package source trees, archives, fixtures, sinks
* ``functions`` – Column functions: tags, evidence regexes, lexers, features,
                  phrases, sentences, prompts
* ``operators`` – DataFrame operators: labels, file choice, version roots,
                  per-version rollup, exact stratified split, metrics
* ``plans``     – end-to-end jobs per registry and the detector job
* ``streaming`` – the stateless describe step on a streaming source
"""

__version__ = "0.1.0"
