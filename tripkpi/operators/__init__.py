"""tripkpi.operators"""
