"""Line-side material supply analytics on Spark DataFrames.

The public functions, by area::

    from linefeed import (clean_pkmc, clean_pk05, clean_fx4pd, assembly_records, forecast,
                          consumption_rows, apply_consumption, restock_candidates, kanban_calls,
                          reception_buffer, preview, upsert, update_by_key, last_per_key,
                          with_dense_index, first_match_in_list, pending_orders, load_table,
                          read_excel, read_snapshots, TableStore, VersionedTable)
"""

from linefeed.operators.index import with_dense_index
from linefeed.operators.merge import last_per_key, update_by_key, upsert
from linefeed.operators.ordered import first_match_in_list, preview
from linefeed.plans.assembly import assembly_records
from linefeed.plans.cleaning import clean_fx4pd, clean_pk05, clean_pkmc
from linefeed.plans.consumption import apply_consumption, consumption_rows
from linefeed.plans.forecast import forecast, reception_buffer
from linefeed.plans.jobs import TableStore
from linefeed.plans.restock import kanban_calls, restock_candidates
from linefeed.plans.sinks import VersionedTable
from linefeed.plans.transfer import pending_orders
from linefeed.sources.excel import read_excel
from linefeed.sources.loader import load_table
from linefeed.sources.snapshots import read_snapshots

__all__ = ["clean_pkmc", "clean_pk05", "clean_fx4pd", "assembly_records", "forecast",
           "consumption_rows", "apply_consumption", "restock_candidates", "kanban_calls",
           "reception_buffer", "preview", "upsert", "update_by_key", "last_per_key",
           "with_dense_index", "first_match_in_list", "pending_orders", "load_table",
           "read_excel", "read_snapshots", "TableStore", "VersionedTable"]
