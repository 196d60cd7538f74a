"""Sources, sinks and payload codecs."""
