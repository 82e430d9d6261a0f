"""The dataset engine's operators as DataFrame transformations."""
