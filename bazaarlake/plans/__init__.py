"""Star schema, marts, reports and insights as DataFrame plans."""
