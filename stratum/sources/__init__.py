"""File sources, manifests and table sinks."""
