"""Reading dated exports and fact tables, writing raw and derived tables."""
