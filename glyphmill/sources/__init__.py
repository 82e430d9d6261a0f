"""Readers and writers: JSON lines, views, PNG images, COCO annotations."""
