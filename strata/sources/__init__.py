"""Sources and sinks: CSV scan, snapshot store, file manifests, registry logs."""
