"""Jobs from DataFrame to DataFrame; nothing here writes."""
