"""Sources and sinks: raw pages, the silver history, CSV and JSON documents."""
