"""tripkpi.plans"""
