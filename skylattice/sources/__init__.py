"""Sources and sinks: rasters, feature arrays, spreadsheets, text files."""
