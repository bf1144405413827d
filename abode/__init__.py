"""abode: dwelling-level energy-efficiency record building on Spark.

Everything is a DataFrame operator built from native Spark expressions:

* ``abode.functions``  Column -> Column helpers (text, dates, numbers, rule tables)
* ``abode.rules``      the ordered category rule tables, as data
* ``abode.sources``    landed-file readers, header normalisation, warehouse scan
* ``abode.operators``  filters, joins, resolution, reshape, quality gates, sinks
* ``abode.plans``      the three programmes (attribute resolution, annual
                       measures, provenance extract) and the driver-table catalogue
* ``abode.streaming``  incremental landing of yearly claim files
"""

from abode.session import build_session, checkpoint_root, stage_table

__all__ = ["build_session", "checkpoint_root", "stage_table"]
