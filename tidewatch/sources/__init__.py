"""Sources and sinks: driver-table bindings, payload harvest jobs, history store."""
