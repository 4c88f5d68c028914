"""chatmill: build and assess chat fine-tuning corpora as Spark DataFrame jobs.

Every capability is a ``DataFrame -> DataFrame`` function (or a ``Column``
expression) so that Catalyst sees one declarative plan.  Python only runs in
tasks where Spark has no built-in (pluggable tokenizers).
"""

__version__ = "0.1.0"
