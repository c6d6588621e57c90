"""Tables and files the operators read and write."""
