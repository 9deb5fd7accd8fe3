"""Writers: tables, exports, snapshots and database publishing."""
