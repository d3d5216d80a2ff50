"""Result sinks: catalog tables, JDBC, versioned keyed snapshots, topics."""
