"""Alert and outcome tables, and topics."""
