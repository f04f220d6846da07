"""Sources and sinks: contracts, driver-table bindings, Bronze landing, layer tables."""
