"""Reusable Column builders."""
