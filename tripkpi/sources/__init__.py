"""tripkpi.sources"""
