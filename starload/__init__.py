"""Star-schema warehouse loads on Spark: parse, upsert, key, bridge, fact, check, analyse."""
