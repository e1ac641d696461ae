"""Reading: raw lines, clean and KPI tables, messages and topics."""
