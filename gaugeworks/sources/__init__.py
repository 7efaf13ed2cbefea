from gaugeworks.sources.fact_table import FactTable
from gaugeworks.sources.landed import in_databases, read_events, read_raw, read_rowset, stamp
from gaugeworks.sources.ledger import RunLedger

__all__ = ["FactTable", "RunLedger", "in_databases", "read_events", "read_raw", "read_rowset", "stamp"]
