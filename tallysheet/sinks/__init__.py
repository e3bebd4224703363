"""Writers: whole-table and partition replace, the mart, and the load audit."""
